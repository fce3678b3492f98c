"""Whole-graph statistics of the directed call graph (known-end edges)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.labels import connected_components


def graph_stats(e: DataFrame) -> DataFrame:
    """One row: n_nodes, n_edges, avg_degree (= 2m/n), density (m/(n(n-1))),
    is_weakly_connected and n_components.

    Vertices are the edge ends (isolated customers are not in this view).
    """
    known = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    nodes = known.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    comps = connected_components(nodes, known)
    m = known.select(F.count(F.lit(1))).scalar()
    k = comps.select(F.count_distinct("component")).scalar()
    n = F.col("n_nodes").cast("double")
    return (nodes.agg(F.count(F.lit(1)).alias("n_nodes"))
            .select("n_nodes", m.alias("n_edges"),
                    (F.lit(2) * m / n).alias("avg_degree"),
                    (m / (n * (n - F.lit(1.0)))).alias("density"),
                    (k == 1).alias("is_weakly_connected"),
                    k.alias("n_components")))
