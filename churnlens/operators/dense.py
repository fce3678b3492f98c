"""Order-keeping dense vertex ids.

Ids of any type become 0 .. n-1 in their own order, so a smallest label is a
smallest number. Rounds over numbers hash-aggregate where strings sort, and
shuffle 8 bytes for an id. The dictionary is range-partitioned; what makes the
places of a partition into numbers is the row count of the partitions before,
one number for each partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.iterate import stored


def dictionary(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, k): the distinct non-null ids of ``ids`` numbered in their order."""
    spark = ids.sparkSession
    placed = stored(ids.select(F.col(id_col).alias("id")).where("id is not null").distinct()
                    .repartitionByRange("id").sortWithinPartitions("id").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    counts = sorted(map(tuple, placed.groupBy(part.alias("p")).agg(F.count(F.lit(1))).collect()))  # a row a partition
    before = accumulate([0] + [n for _, n in counts])
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "p long, before long")
    return placed.join(F.broadcast(offsets), part == F.col("p")).select(
        "id", (F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before")).alias("k"))


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos``, a row's place from 0 in its group by ``order``.

    Range-partitioned by group and order, so a large group lies in many
    partitions; what is windowed are the counts of (group, partition).
    """
    placed = stored(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .withColumn("at_", F.monotonically_increasing_id()))
    part = F.shiftright("at_", 33).alias("part_")
    earlier = Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(placed.groupBy(group, part).agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("k_"))
                    .select(group, "part_", (F.col("first_") - F.coalesce(F.sum("k_").over(earlier), F.lit(0))).alias("shift_")))
    return (placed.withColumn("part_", part).join(counts, [group, "part_"])
            .withColumn("pos", F.col("at_") - F.col("shift_")).drop("at_", "part_", "shift_"))


@dataclass
class DenseGraph:
    """Known-end edges (dst, src) as numbers, and the way back."""

    ids: DataFrame
    edges: DataFrame
    n: int

    @staticmethod
    def of(e: DataFrame) -> DenseGraph:
        known = stored(e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst"))
        ids = stored(dictionary(known.select(F.explode(F.array("src", "dst")).alias("id"))))
        edges = stored(known.join(ids.select(F.col("id").alias("src"), F.col("k").alias("s")), "src")
                       .join(ids.select(F.col("id").alias("dst"), F.col("k").alias("d")), "dst")
                       .select(F.col("d").alias("dst"), F.col("s").alias("src")))
        return DenseGraph(ids, edges, ids.count())

    @property
    def vertices(self) -> DataFrame:
        return self.ids.select(F.col("k").alias("id"))

    def back(self, df: DataFrame, *columns: str) -> DataFrame:
        """``df`` with the numbers in ``columns`` turned into ids."""
        for c in columns:
            df = df.join(self.ids.select(F.col("id").alias("id_"), F.col("k").alias(c)), c).drop(c).withColumnRenamed("id_", c)
        return df
