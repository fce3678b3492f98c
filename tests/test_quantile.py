"""exact_percentile against numpy's linear-interpolation percentile."""

import numpy as np
import pytest

from pyspark.sql.functions import col as spark_col

from churnlens.operators.quantile import exact_percentile


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("accuracy", [100_000, 50, 10])
@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 0.97, 1.0])
def test_matches_numpy_with_hot_value(spark, q, accuracy):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in rng.normal(size=600).round(3)]
    vals += [0.25] * 300  # one value holds a third of the rows
    vals += [None] * 20
    got = exact_percentile(_frame(spark, vals), "x", q, accuracy=accuracy)
    want = np.percentile(np.array([v for v in vals if v is not None]), q * 100)
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_small_and_empty(spark):
    assert exact_percentile(_frame(spark, [None]), "x", 0.5) is None
    assert exact_percentile(_frame(spark, [3.0]), "x", 0.9) == 3.0
    assert exact_percentile(_frame(spark, [1.0, 2.0]), "x", 0.9) == pytest.approx(1.9)


def test_narrows_a_million_distinct_values(spark):
    df = spark.range(1_000_000).select(((spark_col("id") * 7919) % 1_000_003).cast("double").alias("x"))
    values = np.array([(i * 7919) % 1_000_003 for i in range(1_000_000)], float)
    assert exact_percentile(df, "x", 0.9, few=2000) == pytest.approx(np.percentile(values, 90), rel=1e-12)
