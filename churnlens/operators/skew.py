"""Salting of joins between a large table with hot keys and a table of one
row per key.

AQE splits a skewed join only where both sides were shuffled for that join. A
side that was aggregated on the join key, or cached by it, is not. Here the
heavy keys are counted first: a key is heavy when it has more than
1 / (4 * shuffle partitions) of the rows, so there are at most 4 * partitions
of them, whatever the input. Their rows are dealt over several parts, and the
other side's row is copied to each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "part_"
#: Up to so many rows Spark may send a loop's table to all executors.
BROADCAST_ROWS = 20_000


def small(rows: int) -> bool:
    return rows <= BROADCAST_ROWS


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, as a side of a join in a loop. A broadcast
    passes the driver, and Spark's check of its size bounds one of them, not the
    sum over the rounds; so a larger table is shuffled instead."""
    return df if small(rows) else df.hint("merge")


def heavy_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key, parts_) of the heavy keys of ``counts`` (one row per key). The
    result is a local table of at most 4 * shuffle partitions rows."""
    spark = counts.sparkSession
    share = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cap = F.greatest(F.lit(1.0), counts.select(F.sum(n)).scalar() / F.lit(float(share)))
    rows = (counts.where(F.col(n) > cap)
            .select(F.col(key), F.ceil(F.col(n) / cap).cast("int").alias("parts_")).collect())
    return spark.createDataFrame(rows, f"{key} {counts.schema[key].dataType.simpleString()}, parts_ int")


def deal(df: DataFrame, heavy: DataFrame, key: str, by: str) -> DataFrame:
    """``df`` with the column part_: rows of a heavy key by the hash of ``by``."""
    return (df.join(F.broadcast(heavy), key, "left")
            .withColumn(PART, F.coalesce(F.pmod(F.xxhash64(by), F.col("parts_")), F.lit(0)).cast("int"))
            .drop("parts_"))


def copies(df: DataFrame, heavy: DataFrame, key: str) -> DataFrame:
    """``df`` with one row for each part of its key."""
    return (df.join(F.broadcast(heavy), key, "left")
            .withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce("parts_", F.lit(1)) - 1)))
            .drop("parts_"))
