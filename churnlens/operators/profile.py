"""Data-quality profiles and the chart aggregates of the exploration notebook."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _total(df: DataFrame):
    """Row count of ``df`` as a scalar subquery (no join, no driver trip)."""
    return df.select(F.count(F.lit(1))).scalar()


def target_distribution(df: DataFrame, target: str = "churn") -> DataFrame:
    """Rows per class with their share of all rows, in percent."""
    return (df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("percentage", F.col("count") * F.lit(100.0) / _total(df))
            .orderBy(target))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def describe_numeric(df: DataFrame) -> DataFrame:
    """count, mean, stddev (sample), min, max per numeric column, long form.

    One aggregate over all columns, then unpivoted; the same statistics as
    ``describe()`` but typed (doubles), not strings.
    """
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    stats = ("count", "mean", "stddev", "min", "max")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"),
                 F.stddev_samp(x).alias(f"{c}|stddev"), F.min(x).alias(f"{c}|min"),
                 F.max(x).alias(f"{c}|max")]
    wide = df.agg(*aggs)
    rows = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in cols])))
    return rows


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def category_histogram(df: DataFrame, x: str, color: str) -> DataFrame:
    """Counts per (x, color) with the x-category total, ordered by total desc.

    The category total is a window over the already-aggregated counts, so it
    touches one row per (x, color) pair, not the input rows.
    """
    c = counts_by(df, x, color)
    return (c.withColumn("category_total", F.sum("count").over(Window.partitionBy(x)))
             .orderBy(F.desc("category_total"), x, color))


def share(df: DataFrame, names: str) -> DataFrame:
    """Pie-chart shares: count and fraction of all rows per category."""
    return (counts_by(df, names)
            .withColumn("share", F.col("count") / _total(df).cast("double")))


def numeric_histogram(df: DataFrame, x: str, color: str, bin_width: float = 6.0) -> DataFrame:
    """Counts per (bin, color), bins ``[k*w, (k+1)*w)`` starting at 0."""
    start = F.floor(F.col(x) / F.lit(float(bin_width))) * F.lit(float(bin_width))
    return (df.withColumn("bin_start", start.cast("double"))
            .groupBy("bin_start", color).agg(F.count(F.lit(1)).alias("count")))


def bootstrap_sample(df: DataFrame, n: int = 10000, seed: int = 123) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement (none from an empty table).

    Each row is drawn a Poisson number of times, at a rate that gives a few
    more than ``n`` rows, and ``n`` of those are kept at random, which is the
    law of ``n`` independent draws. Too small a total is drawn again.
    """
    total = df.count()
    if total == 0:
        return df
    more = n + 5 * math.sqrt(n) + 10
    while True:
        drawn = df.sample(withReplacement=True, fraction=more / total, seed=seed)
        if drawn.count() >= n:
            return drawn.withColumn("_order", F.rand(seed)).orderBy("_order").limit(n).drop("_order")
        more, seed = more + 5 * math.sqrt(n) + 10, seed + 1
