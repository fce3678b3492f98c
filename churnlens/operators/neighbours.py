"""Averages of customer attributes over each vertex's call neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEIGHBOUR_ATTRS = ["monthly_charges", "total_charges", "tenure"]


def neighbour_pairs(e: DataFrame, direction: str = "both") -> DataFrame:
    """(id, nghb) rows, bag semantics.

    ``both``: every edge seen from each end (forward and reversed edges,
    unioned by name). ``out``: out-neighbours only, which is what the
    reference's union of the renamed edge table with itself computes (each
    row twice; averages are unchanged by the duplication).
    """
    fwd = e.select(F.col("src").alias("id"), F.col("dst").alias("nghb"))
    if direction == "out":
        return fwd
    if direction == "in":
        return e.select(F.col("dst").alias("id"), F.col("src").alias("nghb"))
    if direction != "both":
        raise ValueError(f"direction must be both, out or in, not {direction!r}")
    rev = e.select(F.col("dst").alias("id"), F.col("src").alias("nghb"))
    return fwd.unionByName(rev)


def neighbour_averages(vertices: DataFrame, e: DataFrame, direction: str = "both",
                       attrs: list[str] | None = None) -> DataFrame:
    """Per id: ``nghb_avg_<attr>`` over neighbours (nulls ignored).

    The attribute lookup is a many-to-one join on the neighbour id, so a
    popular neighbour is a hot key only on the pair side (AQE splits it, or
    Spark broadcasts the lookup when its measured size allows). The average
    is a partial+final aggregate, so a hub's neighbours are pre-summed
    map-side.
    """
    attrs = attrs or NEIGHBOUR_ATTRS
    look = vertices.select(F.col("id").alias("nghb"), *attrs)
    pairs = neighbour_pairs(e, direction).where(F.col("id").isNotNull())
    return (pairs.join(look, "nghb", "left")
            .groupBy("id")
            .agg(*[F.avg(a).alias(f"nghb_avg_{a}") for a in attrs]))
