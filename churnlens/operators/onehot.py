"""Customer features: one-hot categoricals, 0/1 label, name cleanup, dropna."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.names import snake_name

# The categorical columns that are one-hot encoded (notebook 02).
CATEGORICAL_COLUMNS = [
    "gender", "partner", "dependents", "senior_citizen",
    "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
    "contract", "paperless_billing", "payment_method",
]

def category_vocabulary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct non-null (column_name, value) pairs, values as strings.

    One distributed job for all columns: each row is exploded into its
    (column, value) pairs and de-duplicated with a partial+final aggregate,
    so only the distinct pairs (the future column names) reach the driver.
    """
    cols = [c for c in (columns or CATEGORICAL_COLUMNS) if c in df.columns]
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])))
    return pairs.where(F.col("value").isNotNull()).distinct()


def collect_vocabulary(df: DataFrame, columns: list[str] | None = None,
                       max_values: int = 1000) -> dict[str, list[str]]:
    """Vocabulary on the driver, sorted by (column, value) (decision D8).

    Each value becomes a column, so ``max_values`` per column is the caller's
    bound. It is checked by a count on the cluster; nothing is collected for a
    column beyond it, which is an error that names the column.
    """
    cols = [c for c in (columns or CATEGORICAL_COLUMNS) if c in df.columns]
    pairs = category_vocabulary(df, cols)
    beyond = [r["column_name"] for r in pairs.groupBy("column_name").count()
              .where(F.col("count") > max_values).collect()]  # a row per column at most
    if beyond:
        raise ValueError(f"columns {sorted(beyond)} have over {max_values} distinct values; not categorical")
    vocab: dict[str, list[str]] = {c: [] for c in cols}
    for row in pairs.collect():
        vocab[row["column_name"]].append(row["value"])
    for values in vocab.values():
        values.sort()
    return vocab


def customer_features(df: DataFrame, vocab: dict[str, list[str]] | None = None) -> DataFrame:
    """One-hot encode the categoricals in a single projection.

    ``vocab`` (column -> values) may be supplied so that scoring reuses the
    training columns; otherwise it is computed from ``df``. Null categories
    give all zeros. ``churn`` becomes 1 for ``'Yes'`` and 0 otherwise (null
    included). Rows with any null left are dropped.
    """
    if vocab is None:
        vocab = collect_vocabulary(df)
    encoded = set(vocab)
    out = []
    names: dict[str, str] = {}
    for c in df.columns:
        if c in encoded:
            continue
        expr = F.when(F.col("churn") == "Yes", 1).otherwise(0) if c == "churn" else F.col(c)
        out.append((c, expr))
    for c in CATEGORICAL_COLUMNS + sorted(encoded - set(CATEGORICAL_COLUMNS)):
        if c not in encoded:
            continue
        src_type = dict(df.dtypes)[c]
        for v in vocab[c]:
            lit = F.lit(v).cast(src_type) if src_type != "string" else F.lit(v)
            out.append((f"{c}_{snake_name(v)}",
                        F.when(F.col(c) == lit, 1).otherwise(0)))
    final = []
    for name, expr in out:
        clean = snake_name(name)
        if clean in names:
            raise ValueError(f"feature name collision: {name!r} and {names[clean]!r} -> {clean!r}")
        names[clean] = name
        final.append(expr.alias(clean))
    return df.select(final).na.drop("any")
