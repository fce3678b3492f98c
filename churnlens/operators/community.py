"""Community statistics over a (id, label) assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.skew import PART, copies, deal, heavy_keys

COMMUNITY_ATTRS = ["monthly_charges", "total_charges", "tenure"]


def community_stats(labels: DataFrame, vertices: DataFrame,
                    attrs: list[str] | None = None) -> DataFrame:
    """Per label: average of each attribute and the member count.

    A community holding a large share of all vertices is one hot group, but
    the averages are partial+final aggregates, so its members are summed
    map-side first.
    """
    attrs = attrs or COMMUNITY_ATTRS
    members = labels.join(vertices.select("id", *attrs), "id")
    return (members.groupBy("label")
            .agg(*[F.avg(a).alias(f"comm_avg_{a}") for a in attrs],
                 F.count("id").alias("comm_size")))


def community_deviation(labels: DataFrame, vertices: DataFrame,
                        attrs: list[str] | None = None) -> DataFrame:
    """Per vertex: its community's averages and size, and for each
    attribute ``comm_dev_avg_<a>`` = community average minus own value.

    The per-label statistics are one row per community, joined back on the
    label; members of a giant community are dealt over parts of its label.
    """
    attrs = attrs or COMMUNITY_ATTRS
    stats = community_stats(labels, vertices, attrs)
    members = labels.join(vertices.select("id", *attrs), "id")
    heavy = heavy_keys(stats, "label", "comm_size")
    j = deal(members, heavy, "label", "id").join(copies(stats, heavy, "label"), ["label", PART], "left")
    return j.select("id", "label",
                    *[f"comm_avg_{a}" for a in attrs], "comm_size",
                    *[(F.col(f"comm_avg_{a}") - F.col(a)).alias(f"comm_dev_avg_{a}")
                      for a in attrs])


def community_sizes(labels: DataFrame) -> DataFrame:
    """Number of communities, largest size and mean size (one row)."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("n_communities"),
                     F.max("size").alias("largest_community"),
                     F.avg("size").alias("avg_community_size"))


def component_sizes(components: DataFrame) -> DataFrame:
    """Number of components and the largest one's size (one row)."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.count(F.lit(1)).alias("n_components"),
                     F.max("size").alias("largest_component"))
