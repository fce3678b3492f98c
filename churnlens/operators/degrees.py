"""Degree, in-degree and out-degree as one aggregate and one join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import safe_ratio


def degree_counts(e: DataFrame) -> DataFrame:
    """(id, degree, in_degree, out_degree) for every id that ends an edge.

    Each edge is turned into its two ends in one pass (``inline`` of a
    two-element array) and counted with one partial+final aggregate, so a hub
    is pre-counted map-side and never gathers its edges in one task. A
    self-loop adds one to each direction, so two to ``degree``.
    """
    ends = e.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )))
    return (ends.where(F.col("id").isNotNull())
            .groupBy("id")
            .agg(F.count(F.lit(1)).alias("degree"),
                 F.sum("i").cast("bigint").alias("in_degree"),
                 F.sum("o").cast("bigint").alias("out_degree")))


def degree_features(vertices: DataFrame, e: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Per vertex: degree, in_degree, out_degree; 0 for vertices without edges.

    The reference joins three separate degree tables; one aggregate joined
    once gives the same columns with one shuffle of the edges.
    """
    deg = degree_counts(e).withColumnRenamed("id", id_col)
    return (vertices.select(id_col).join(deg, id_col, "left")
            .na.fill(0, ["degree", "in_degree", "out_degree"]))


def with_degree_ratios(df: DataFrame) -> DataFrame:
    return (df.withColumn("in_degree_ratio", safe_ratio("in_degree", "degree"))
              .withColumn("out_degree_ratio", safe_ratio("out_degree", "degree")))


def degree_centrality(e: DataFrame) -> DataFrame:
    """Degree / (n - 1) over the graph of known-end edges (NetworkX form).

    Vertices are the edge ends, as when a directed graph is built from an edge
    list; ``degree`` counts in + out edges.
    """
    known = e.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    deg = degree_counts(known)
    n = deg.select(F.count(F.lit(1)).cast("double")).scalar()
    return deg.select(
        "id", "degree",
        F.when(n > 1, F.col("degree") / (n - F.lit(1.0))).otherwise(F.lit(1.0))
         .alias("degree_centrality"))
