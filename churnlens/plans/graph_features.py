"""The per-customer graph feature table (18 features + customer_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import clustering_coefficient
from churnlens.operators import community, degrees, labels, neighbours, pagerank, triangles
from churnlens.operators.dense import DenseGraph
from churnlens.operators.iterate import stored

GRAPH_FEATURE_COLUMNS = [
    "customer_id", "degree", "in_degree", "out_degree", "in_degree_ratio",
    "out_degree_ratio", "pagerank", "trian_count", "cc",
    "comm_avg_monthly_charges", "comm_avg_total_charges", "comm_avg_tenure",
    "comm_size", "comm_dev_avg_monthly_charges", "comm_dev_avg_total_charges",
    "comm_dev_avg_tenure", "nghb_avg_monthly_charges", "nghb_avg_total_charges",
    "nghb_avg_tenure",
]


def graph_features(customers: DataFrame, e: DataFrame, pagerank_iter: int = 10,
                   label_iter: int = 25, neighbour_direction: str = "both") -> DataFrame:
    """All graph features for every customer; nulls become 0.

    ``customers``: silver customers (customer_id, monthly_charges,
    total_charges, tenure, ...). ``e``: the (dst, src) edge table. Degrees use
    every edge, including those with an off-network end; PageRank, triangles
    and communities use edges with both ends known (decision D2).

    Every partial result is keyed by customer id and joined once; the edge
    table is stored because six operators read it, and so is its dense form, on
    which the iterated ones run.
    """
    e = stored(e.select("dst", "src"))
    g = DenseGraph.of(e)
    v = customers.select(F.col("customer_id").alias("id"), "monthly_charges",
                         "total_charges", "tenure")
    ids = v.select("id")
    deg = degrees.with_degree_ratios(degrees.degree_features(customers, e))
    pr = pagerank.pagerank(ids, e, max_iter=pagerank_iter, graph=g).withColumnRenamed("id", "customer_id")
    tri = g.back(triangles.triangle_counts(g.edges), "id").withColumnRenamed("id", "customer_id")
    lab = labels.label_propagation(ids, e, max_iter=label_iter, graph=g)
    comm = (community.community_deviation(lab, v).drop("label")
            .withColumnRenamed("id", "customer_id"))
    nb = (neighbours.neighbour_averages(v, e, neighbour_direction)
          .withColumnRenamed("id", "customer_id"))
    out = (deg.join(pr, "customer_id", "left")
           .join(tri, "customer_id", "left")
           .withColumn("trian_count", F.coalesce("triangles", F.lit(0)).cast("bigint"))
           .drop("triangles")
           .withColumn("cc", clustering_coefficient("trian_count", "degree"))
           .join(comm, "customer_id", "left")
           .join(nb, "customer_id", "left"))
    return out.select(GRAPH_FEATURE_COLUMNS).na.fill(0)
