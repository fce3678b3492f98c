"""Exact percentile of a column without gathering its values in one task.

Spark's exact ``percentile`` keeps one counter per distinct value and merges
them all in a single task, which does not hold for a continuous metric over
billions of rows. Here the answer is found in distributed passes:

1. ``percentile_approx`` (a mergeable sketch) of the values inside the current
   bracket gives a narrower bracket [a, b] around the wanted ranks;
2. one aggregate counts the rows below ``a`` and up to ``b``, which proves that
   the bracket holds the ranks (otherwise it is widened and retried);
3. this repeats until at most ``FEW`` distinct values are left inside, whatever
   the input's size; only those are ordered, to read the values at the ranks.

The result equals linear-interpolation percentile (numpy's default, Spark's
``percentile``, DuckDB's ``quantile_cont``): with ``pos = q (n - 1)`` it is
``v[floor(pos)] + (pos - floor(pos)) (v[ceil(pos)] - v[floor(pos)])`` over
the sorted non-null values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Distinct values that one task may order.
FEW = 10_000


def exact_percentile(df: DataFrame, col: str, q: float, accuracy: int = ACCURACY,
                     few: int = FEW) -> float | None:
    """Linear-interpolation ``q``-percentile of ``col`` (nulls ignored);
    None when the column has no values."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    n = x.count()
    if n == 0:
        return None
    pos = q * (n - 1)
    klo, khi = math.floor(pos), math.ceil(pos)
    inside, below, size = x, 0, n
    eps = 4.0 / accuracy
    while inside.select("x").distinct().count() > few:
        ra, rb = (klo - below) / size - eps, (khi + 1 - below) / size + eps
        a, b = inside.agg(F.percentile_approx("x", [max(0.0, ra), min(1.0, rb)], accuracy)).first()[0]
        part = inside.where((F.col("x") >= F.lit(a)) & (F.col("x") <= F.lit(b)))
        before, count = inside.agg(F.count_if(F.col("x") < F.lit(a)), F.count_if(
            (F.col("x") >= F.lit(a)) & (F.col("x") <= F.lit(b)))).first()
        if below + before <= klo and below + before + count > khi:
            if count == size:
                break  # no narrower bracket: the sketch's step is the whole range
            inside, below, size = part, below + before, count
        else:
            eps *= 4.0
    counts = inside.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    cum = F.sum("c").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    spans = counts.select("x", (F.lit(below) + cum - F.col("c")).alias("first"),
                          (F.lit(below) + cum - F.lit(1)).alias("last"))

    def at(k: int):
        return F.max(F.when((F.col("first") <= k) & (F.col("last") >= k), F.col("x")))

    r = spans.agg(at(klo).alias("lo"), at(khi).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if khi == klo:
        return lo
    return (khi - pos) * lo + (pos - klo) * hi
