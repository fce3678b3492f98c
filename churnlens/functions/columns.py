"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
the reference's two Python UDFs (degree ratio and clustering coefficient)
become plain ``CASE`` arithmetic here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(x: Column | str, d: Column | str) -> Column:
    """``x / d`` as a double, 0.0 when ``d`` is 0."""
    x, d = _c(x), _c(d)
    return F.when(d == 0, F.lit(0.0)).otherwise(x.cast("double") / d.cast("double"))


def clustering_coefficient(t: Column | str, e: Column | str) -> Column:
    """Triangles over C(e, 2); 0.0 when either count is 0."""
    t, e = _c(t), _c(e)
    pairs = e.cast("double") * (e.cast("double") - F.lit(1.0)) / F.lit(2.0)
    return (F.when((t == 0) | (e == 0), F.lit(0.0))
             .otherwise(t.cast("double") / pairs))


def round4(x: Column | str) -> Column:
    """Comparison rounding: floor(x*10000 + 0.500001)/10000 (exact-tie safe)."""
    x = _c(x)
    return F.floor(x * F.lit(10000.0) + F.lit(0.500001)) / F.lit(10000.0)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Dashboard bucket labels and thresholds (notebook 05).
RISK_BUCKETS = [(0.8, "High Risk"), (0.6, "Medium Risk"), (0.4, "Low Risk")]
RISK_DEFAULT = "Very Low Risk"
TENURE_BUCKETS = [(60, "Long-term (>5 years)"), (24, "Medium-term (2-5 years)"),
                  (12, "Short-term (1-2 years)")]
TENURE_DEFAULT = "New (<1 year)"
CONFIDENCE_BUCKETS = [(0.9, "Very High Confidence"), (0.7, "High Confidence"),
                      (0.5, "Medium Confidence")]
CONFIDENCE_DEFAULT = "Low Confidence"


def bucket(x: Column | str, thresholds: list[tuple[float, str]], default: str) -> Column:
    """First label whose threshold ``x`` reaches (``>=``), else ``default``."""
    x = _c(x)
    out = None
    for t, label in thresholds:
        out = F.when(x >= t, label) if out is None else out.when(x >= t, label)
    return out.otherwise(default)


def risk_category(p: Column | str) -> Column:
    return bucket(p, RISK_BUCKETS, RISK_DEFAULT)


def tenure_category(t: Column | str) -> Column:
    return bucket(t, TENURE_BUCKETS, TENURE_DEFAULT)


def confidence_level(p: Column | str) -> Column:
    return bucket(p, CONFIDENCE_BUCKETS, CONFIDENCE_DEFAULT)


def bucket_sql(expr: str, thresholds: list[tuple[float, str]], default: str) -> str:
    """The same bucketing as SQL text, for the oracle."""
    whens = " ".join(f"WHEN {expr} >= {t} THEN '{label}'" for t, label in thresholds)
    return f"CASE {whens} ELSE '{default}' END"
