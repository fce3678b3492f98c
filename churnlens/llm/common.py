"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: bytes.translate table that lower-cases A-Z only
ASCII_LOWER = bytes(range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))

#: DuckDB CTE with the table of the CRC-32, and the checksum of an ASCII string
CRC_TABLE_SQL = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
  CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END, i::BIGINT)) AS crc_t)"""


def crc32_sql(text: str) -> str:
    return (f"xor(4294967295::BIGINT, list_reduce(list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT), "
            "lambda a, b: xor(a // 256, crc_t[xor(a % 256, b) + 1]), 4294967295::BIGINT))")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")


#: Rows and bytes of an Arrow batch that goes to a Python worker. A batch lies
#: in the JVM's buffers, in the worker's, and in part as Python objects.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def _size(setting: str | None) -> int:
    """A number, or bytes with a unit; 0 where there is none."""
    number, unit = re.fullmatch(r"(-?\d*)\s*([kmgt]?)b?", (setting or "").lower()).groups()
    return int(number or 0) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most BATCH for what is run inside; smaller settings
    of the session hold."""
    before = {k: spark.conf.get(k, None) for k in BATCH}
    try:
        for k, most in BATCH.items():
            now = _size(before[k])
            spark.conf.set(k, str(min(now, most) if now > 0 else most))
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def released(batches):
    """Batches of a Python stage; when the task is done, Arrow gives what it
    holds back to the system, as the worker lives on for other tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor rereads files, and gives the
    planner the true size of the table (a small one is then broadcast by
    Spark's own size check, a large one is shuffled and skew-split).
    """
    path = scratch(df.sparkSession, tag)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def without(docs: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in the one-column table
    ``removed``; the table is written first, so its size decides the join."""
    gone = written(removed.select(F.col(removed.columns[0]).alias(key)).distinct(), "removed")
    return docs.join(gone, key, "left_anti").select(docs.columns)


def word_count(text: Column) -> Column:
    """Words: runs without ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("long")


def slices(batches, rows: int = 256):
    """Arrow batches of a few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pairs(batches, rows: int = 256):
    """Values of the first two columns of Arrow batches, a few rows at a time:
    a batch of long texts is never held as Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``pos``, a row's position from 0 in its group by ``order``
    (nulls first), and ``n``, the group's size. ``group`` holds no nulls.

    Rows are range-partitioned by group and order, so a large group lies in many
    partitions, and written with their place; the group's rows in the
    partitions before are added to the place within the partition. What is
    windowed are (partition, group) counts, at most one per partition in a group.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("at_", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at_", 33).alias("part_")
    whole, before = Window.partitionBy(group), Window.partitionBy(group).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(placed.groupBy(group, part).agg(F.min("at_").alias("first_"), F.count(F.lit(1)).alias("k_"))
                     .select(group, "part_", (F.col("first_") - F.coalesce(F.sum("k_").over(before), F.lit(0))).alias("shift_"),
                             F.sum("k_").over(whole).alias("n")), "counts")
    return (placed.withColumn("part_", part).join(counts, [group, "part_"])
            .withColumn("pos", F.col("at_") - F.col("shift_")).drop("at_", "part_", "shift_"))
