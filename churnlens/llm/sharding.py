"""Sharding by vector bin packing.

Rows are grouped by equal texts. A group's vector is its bytes, tokens and
rows as shares of one shard's capacity. Groups of more than 1 / ``FINE`` of a
shard in any dimension are units of their own, of which there are at most
3 * FINE * shards; all others are gathered by hash into FINE * shards bundles.
A group larger than a whole shard, which no assignment could balance, is cut
by the hash of its ids. So the units are bounded in number whatever the input,
and equal texts share a shard unless their group exceeds one.

Units are placed by decreasing size, each into the shard where the dot product
of its vector with the residual capacity is highest, among the shards whose
residual bytes still hold it. The rows then learn their shard from the table of
units, and their slot from counts of (unit, slice), slices being about
``SLICE`` rows, so no window spans a shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import word_count, written

FINE = 512
SLICE = 20_000


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit. ``vectors``: a row per unit, bytes first, as shares
    of one shard's capacity."""
    residual = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    for i in sorted(range(len(vectors)), key=lambda i: (-vectors[i].max(), i)):
        v = vectors[i]
        fits = residual[:, 0] >= v[0] - 1e-12
        gain = residual @ v
        s = int(np.argmax(np.where(fits, gain, -np.inf))) if fits.any() else int(np.argmax(residual[:, 0]))
        out[i] = s
        residual[s] -= v
    return out


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) of
    every row.

    size: UTF-8 bytes of the text, 0 if null, plus 1. Sizes of shards are near
    equal, with tokens (words) and rows balanced as far as they go along. Null
    and empty texts are one group. slot counts a shard's rows from 0 without
    gaps, a unit after another and by id within (then size and checksum; rows that
    agree in all of these are alike, so either order is the same result). Equal
    texts share a shard, however long, unless their group has more bytes than a
    shard: it is then cut by the hash of the ids. Groups below 1 / ``FINE`` of a
    shard are placed as bundles. Ids may be null or repeat. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.unhex(F.md5(text)).alias("g"),
        word_count(text).alias("tokens")), "rows")
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    cap = [max(1, x or 0) / shards for x in total]
    groups = rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                   F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.col("bytes") / cap[0], F.col("tokens") / cap[1], F.col("n") / cap[2])
    large = written(groups.withColumn("share", share).where(F.col("share") * FINE > 1).select(
        "g", F.greatest(F.lit(1), F.ceil(F.when(F.col("bytes") > cap[0], 4 * F.col("bytes") / cap[0]).otherwise(1)))
        .cast("int").alias("pieces")), "large-groups")
    key = F.when(F.col("pieces").isNull(), F.concat(F.lit("b"), F.pmod(F.xxhash64("g"), F.lit(FINE * shards)))).otherwise(
        F.concat(F.lower(F.hex("g")), F.lit("/"), F.pmod(F.xxhash64("id"), F.col("pieces"))))
    # at most 3 * FINE * shards rows of 20 bytes
    named = rows.join(F.broadcast(large), "g", "left").withColumn("unit", key).drop("pieces")
    units = named.groupBy("unit").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                      F.count(F.lit(1)).alias("n")).orderBy("unit").collect()
    at = place(np.array([[u["bytes"] / cap[0], u["tokens"] / cap[1], u["n"] / cap[2]] for u in units]).reshape(-1, 3), shards)
    plan = spark.createDataFrame([(u["unit"], int(s), -(-u["n"] // SLICE)) for u, s in zip(units, at)],
                                 "unit string, shard int, slices long")
    sliced = named.join(F.broadcast(plan), "unit").withColumn(
        "slice", F.pmod(F.xxhash64("id", F.lit("slice")), F.col("slices"))).drop("slices", "tokens", "g")
    before = Window.partitionBy("shard").orderBy("unit", "slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sliced.groupBy("shard", "unit", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        "unit", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    nth = F.row_number().over(Window.partitionBy("unit", "slice").orderBy("id", "size", "crc"))
    return (sliced.withColumn("nth", nth).join(offsets, ["unit", "slice"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                    "shard", (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
