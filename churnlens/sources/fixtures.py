"""Telecom-shaped inputs derived from the supplied TPC-H-like tables.

The supplied tables hold no subscriber or call data, so the subscriber table,
the call log and the model scores are derived from ``customer`` and
``orders`` with arithmetic only. The DataFrame code here and the SQL text in
``FIXTURE_SQL`` describe the same rows; the SQL serves the DuckDB oracle.

At scale ``customer`` and ``orders`` are the two large inputs; everything here
is a narrow projection except ``edges``, which joins the call log to the
subscriber lookup twice. Calls are reduced to distinct number pairs before
those joins, so repeated calls between the same two numbers cost one row.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _phone(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 7, "0"))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscriber per customer, 22 columns in the bronze order."""
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    nat = F.col("c_nationkey")
    tenure = (k * 7) % 73
    cents = F.lit(1825) + (k * 37) % 10000

    def yes_if(cond: Column) -> Column:
        return F.when(cond, "Yes").otherwise("No")

    return c.select(
        k.cast("string").alias("customer_id"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(k % 6 == 0, 1).otherwise(0).alias("senior_citizen"),
        yes_if(k % 5 < 2).alias("partner"),
        yes_if(k % 7 < 2).alias("dependents"),
        tenure.cast("int").alias("tenure"),
        F.when(k % 10 == 9, "No").otherwise("Yes").alias("phone_service"),
        F.when(k % 10 == 9, "No phone service")
         .when(k % 3 == 0, "Yes").otherwise("No").alias("multiple_lines"),
        F.when(nat % 3 == 0, "DSL").when(nat % 3 == 1, "Fiber optic")
         .otherwise("No").alias("internet_service"),
        yes_if(k % 4 == 1).alias("online_security"),
        yes_if(k % 4 == 2).alias("online_backup"),
        yes_if(k % 8 < 3).alias("device_protection"),
        yes_if(k % 9 < 4).alias("tech_support"),
        yes_if(k % 11 < 5).alias("streaming_tv"),
        yes_if(k % 13 < 6).alias("streaming_movies"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Two year")
         .when(F.col("c_mktsegment") == "MACHINERY", "One year")
         .otherwise("Month-to-month").alias("contract"),
        yes_if(F.col("c_acctbal") > 2000).alias("paperless_billing"),
        F.when(nat % 4 == 0, "Electronic check")
         .when(nat % 4 == 1, "Mailed check")
         .when(nat % 4 == 2, "Bank transfer (automatic)")
         .otherwise("Credit card (automatic)").alias("payment_method"),
        (cents.cast("double") / F.lit(100.0)).alias("monthly_charges"),
        F.when(tenure == 0, F.lit(" "))
         .otherwise((cents * tenure).cast("string")).alias("total_charges"),
        F.when(k % 97 == 13, F.lit(None).cast("string"))
         .otherwise(_phone("555-", k)).alias("mobile_number"),
        yes_if((tenure < 24) & (k % 5 < 3)).alias("churn"),
    )


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call per order; callees skewed toward low customer keys."""
    n = (read_table(spark, sf_dir, "customer")
         .select(F.count(F.lit(1)).cast("double")).scalar())
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    ok = F.col("o_orderkey")
    u = ((ok * 7919) % 100003).cast("double") / F.lit(100003.0)
    callee_key = F.floor(n * u * u * u).cast("bigint")
    return o.select(
        F.col("o_orderdate").cast("string").alias("datatime"),
        _phone("555-", F.col("o_custkey")).alias("caller_mobile_number"),
        F.when(ok % 11 == 0, _phone("999-", ok))
         .otherwise(_phone("555-", callee_key)).alias("callee_mobile_number"),
        (F.lit(9) + ok % 43).cast("int").alias("duration"),
    )


def customer_mobile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (subscribers(spark, sf_dir)
            .where(F.col("mobile_number").isNotNull())
            .select("customer_id", "mobile_number"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stand-in model output for oracle-checked gold queries."""
    k = F.col("c_custkey")
    bucket = (k * 7919) % 1000
    return read_table(spark, sf_dir, "customer").select(
        k.cast("string").alias("customer_id"),
        (bucket.cast("double") / F.lit(1000.0)).alias("p_churn"),
        F.when(bucket >= 500, 1).otherwise(0).alias("prediction"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.operators.edges import build_edges
    return build_edges(call_log(spark, sf_dir), subscribers(spark, sf_dir))


def known_edges(e: DataFrame) -> DataFrame:
    """Edges whose two ends are both subscribers (decision D2)."""
    return e.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def bucket_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every known edge, its callee moved into the caller's last-digit bucket
    (customer keys are 0 to 10 k - 1): several components, no edge left out."""
    s, d = F.col("src").cast("bigint"), F.col("dst").cast("bigint")
    return known_edges(edges(spark, sf_dir)).select(
        (d - d % 10 + s % 10).cast("string").alias("dst"), "src").distinct()


# The derived-view SQL from FIXTURES.md section B, used verbatim
# by the DuckDB oracle (as CTEs). The scalar count is a subquery, which gives
# the same rows as the one-row cross join written in FIXTURES.md.
FIXTURE_SQL = {
    "subscribers": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS customer_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS senior_citizen,
  CASE WHEN c_custkey % 5 < 2 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN c_custkey % 7 < 2 THEN 'Yes' ELSE 'No' END AS dependents,
  CAST((c_custkey * 7) % 73 AS INT) AS tenure,
  CASE WHEN c_custkey % 10 = 9 THEN 'No' ELSE 'Yes' END AS phone_service,
  CASE WHEN c_custkey % 10 = 9 THEN 'No phone service' WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
  CASE WHEN c_custkey % 4 = 1 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN c_custkey % 4 = 2 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN c_custkey % 8 < 3 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN c_custkey % 9 < 4 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN c_custkey % 11 < 5 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN c_custkey % 13 < 6 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Two year' WHEN 'MACHINERY' THEN 'One year' ELSE 'Month-to-month' END AS contract,
  CASE WHEN c_acctbal > 2000 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
    WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
  CAST(1825 + (c_custkey * 37) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS monthly_charges,
  CASE WHEN (c_custkey * 7) % 73 = 0 THEN ' '
    ELSE CAST((1825 + (c_custkey * 37) % 10000) * ((c_custkey * 7) % 73) AS VARCHAR(20)) END AS total_charges,
  CASE WHEN c_custkey % 97 = 13 THEN NULL
    ELSE concat('555-', lpad(CAST(c_custkey AS VARCHAR(20)), 7, '0')) END AS mobile_number,
  CASE WHEN (c_custkey * 7) % 73 < 24 AND c_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS churn
FROM customer""",
    "call_log": """
SELECT CAST(o_orderdate AS VARCHAR(30)) AS datatime,
  concat('555-', lpad(CAST(o_custkey AS VARCHAR(20)), 7, '0')) AS caller_mobile_number,
  CASE WHEN o_orderkey % 11 = 0 THEN concat('999-', lpad(CAST(o_orderkey AS VARCHAR(20)), 7, '0'))
    ELSE concat('555-', lpad(CAST(CAST(floor(n * u * u * u) AS BIGINT) AS VARCHAR(20)), 7, '0')) END AS callee_mobile_number,
  CAST(9 + o_orderkey % 43 AS INT) AS duration
FROM (SELECT o.*, CAST((o_orderkey * 7919) % 100003 AS DOUBLE) / CAST(100003 AS DOUBLE) AS u,
             (SELECT CAST(count(*) AS DOUBLE) FROM customer) AS n
      FROM orders o) t""",
    "edges": """
SELECT DISTINCT b.customer_id AS dst, a.customer_id AS src
FROM call_log k
LEFT JOIN subscribers a ON k.caller_mobile_number = a.mobile_number
LEFT JOIN subscribers b ON k.callee_mobile_number = b.mobile_number""",
    "scores": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS customer_id,
  CAST((c_custkey * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS p_churn,
  CASE WHEN (c_custkey * 7919) % 1000 >= 500 THEN 1 ELSE 0 END AS prediction
FROM customer""",
    "bucket_edges": """
SELECT DISTINCT CAST(CAST(dst AS BIGINT) - CAST(dst AS BIGINT) % 10 + CAST(src AS BIGINT) % 10 AS VARCHAR(20)) AS dst, src
FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL""",
    "customer_mobile": """
SELECT customer_id, mobile_number FROM subscribers WHERE mobile_number IS NOT NULL""",
}

# Which derived views each view needs, in definition order.
_VIEW_DEPS = {
    "subscribers": [],
    "call_log": [],
    "scores": [],
    "edges": ["subscribers", "call_log"],
    "bucket_edges": ["subscribers", "call_log", "edges"],
    "customer_mobile": ["subscribers"],
}


def with_views(sql: str, views: list[str], extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the derived views it uses as CTEs (oracle side)."""
    order: list[str] = []
    for v in views:
        for dep in _VIEW_DEPS[v] + [v]:
            if dep not in order:
                order.append(dep)
    ctes = [f"{v} AS ({FIXTURE_SQL[v]}\n)" for v in order]
    ctes += [f"{name} AS ({body}\n)" for name, body in (extra or [])]
    if not ctes:
        return sql
    recursive = any("(" in name for name, _ in (extra or []))  # only recursive ones name their columns
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + sql
