"""Exact duplicates: 128-bit content hash, byte comparison inside each group.

Native: DataFrame functions only.

1. ``(hash, text)`` is aggregated to the id that stays and a count. The text
   is part of the grouping key, so equal hashes with different bytes give
   separate rows; copies combine before the shuffle, which splits a group that
   holds a third of all rows into one row per map task.
2. The rows of step 1 are reduced to one per hash, without text. Only hashes
   with two or more rows are written to the shared folder.
3. Every document is joined to that table on the hash; only ids and digests
   are shuffled. A group's row is unique, so a hot hash is a skewed join with
   one matching row, which AQE splits (neither side is aggregated in place).

Hashes with several texts (collisions) are resolved by joining on hash and
text; when there are none that branch is not planned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import ascii_lower, written


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stays: str = "largest", normalise: Callable[[Column], Column] = ascii_lower,
                digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. A null text counts as
    empty, so null and empty texts form one group. ``keep_id`` is the largest
    (or smallest) id of the group; null ids never win over others, and a group
    with only null ids has a null ``keep_id``. Exactly one row of each group is
    ``kept``: of rows repeated with the same id and text, one. An empty table
    gives an empty result. Other columns of ``docs`` are ignored, whatever
    their names.
    """
    pick = {"largest": F.max, "smallest": F.min}[stays]
    rows = docs.select(F.col(id_col).alias("id"),
                       normalise(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    rows = rows.withColumn("h", digest(F.col("t")))
    texts = rows.groupBy("h", "t").agg(pick("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    classes = written(
        texts.groupBy("h").agg(F.first("keep").alias("keep"), F.sum("n").alias("n"),
                               F.count(F.lit(1)).alias("variants")).where("n > 1"),
        "dup-classes")
    keyed = rows.select("id", "h", F.sha2("t", 256).alias("sha"),
                        F.row_number().over(Window.partitionBy("id", "h").orderBy("h")).alias("nth"))
    clash = classes.where("variants > 1")
    if clash.isEmpty():
        joined = keyed.join(classes.select("h", "keep", "n"), "h", "left")
    else:
        joined = _by_text(rows, texts, clash).unionByName(
            keyed.join(clash.select("h"), "h", "left_anti")
            .join(classes.where("variants = 1").select("h", "keep", "n"), "h", "left"))
    n = F.coalesce("n", F.lit(1)).cast("long")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), n.alias("group_size"),
        (F.col("id").eqNullSafe(keep) & (F.col("nth") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))


def _by_text(rows: DataFrame, texts: DataFrame, clash: DataFrame) -> DataFrame:
    """Members of hashes that several texts share, matched by their bytes."""
    h = clash.select("h")
    mine = rows.join(h, "h", "left_semi").withColumn(
        "nth", F.row_number().over(Window.partitionBy("id", "h", "t").orderBy("h")))
    exact = written(texts.join(h, "h", "left_semi"), "clash-texts")
    return mine.join(exact, ["h", "t"]).select(
        "id", "h", F.sha2("t", 256).alias("sha"), "nth", "keep", "n")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""
