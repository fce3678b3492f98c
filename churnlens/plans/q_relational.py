"""Relational queries: ingest, features, profiles, gold roll-ups."""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import (CONFIDENCE_BUCKETS, CONFIDENCE_DEFAULT,
                                         RISK_BUCKETS, RISK_DEFAULT, TENURE_BUCKETS,
                                         TENURE_DEFAULT, bucket_sql)
from churnlens.operators import onehot, profile
from churnlens.plans import dashboard as dash
from churnlens.plans.queries import r4, register, rounded
from churnlens.session import scratch_path
from churnlens.sources import fixtures as fx
from churnlens.sources import ingest
from churnlens.sources.fixtures import with_views

# ------------------------------------------------------------ Spark inputs


def silver(spark, sf_dir) -> DataFrame:
    return ingest.silver_customers(fx.subscribers(spark, sf_dir))


def customer_features(spark, sf_dir) -> DataFrame:
    return onehot.customer_features(silver(spark, sf_dir).drop("mobile_number"))


def predictions(spark, sf_dir) -> DataFrame:
    """The deterministic scores in model-output shape (probability array)."""
    s = fx.scores(spark, sf_dir)
    return s.select("customer_id", "prediction",
                    F.array(F.lit(1.0) - F.col("p_churn"), F.col("p_churn")).alias("probability"))


def customer_facts(spark, sf_dir) -> DataFrame:
    """The columns of ``customer_features`` that are no categories, straight
    from silver with the same null filter; no vocabulary pass."""
    s = silver(spark, sf_dir).drop("mobile_number")
    return s.na.drop("any", subset=[c for c in s.columns if c not in (*onehot.CATEGORICAL_COLUMNS, "churn")]).select(
        "customer_id", "tenure", "monthly_charges", "total_charges",
        F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("churn"))


def dashboard(spark, sf_dir) -> DataFrame:
    return dash.dashboard_rows(predictions(spark, sf_dir), customer_facts(spark, sf_dir))


def input_path(sf_dir: str) -> str:
    """A name for an input folder: the hash of its whole path."""
    return hashlib.sha256(os.path.abspath(sf_dir).encode()).hexdigest()[:12]


def run_path(sf_dir: str) -> str:
    """A name for one run over one input folder: its name and a fresh id, so no
    two runs share files."""
    return f"{input_path(sf_dir)}_{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------------ oracle CTEs

SILVER_SQL = """
SELECT * REPLACE (TRY_CAST(total_charges AS DOUBLE) AS total_charges) FROM subscribers"""

# The documented category domains of the customer table and
# the feature-column name each value gets (FIXTURES.md A1, A6).
ONEHOT_DOMAIN = [
    ("gender", "'Female'", "gender_female"), ("gender", "'Male'", "gender_male"),
    ("partner", "'No'", "partner_no"), ("partner", "'Yes'", "partner_yes"),
    ("dependents", "'No'", "dependents_no"), ("dependents", "'Yes'", "dependents_yes"),
    ("senior_citizen", "0", "senior_citizen_0"), ("senior_citizen", "1", "senior_citizen_1"),
    ("phone_service", "'No'", "phone_service_no"), ("phone_service", "'Yes'", "phone_service_yes"),
    ("multiple_lines", "'No'", "multiple_lines_no"),
    ("multiple_lines", "'No phone service'", "multiple_lines_no_phone_service"),
    ("multiple_lines", "'Yes'", "multiple_lines_yes"),
    ("internet_service", "'DSL'", "internet_service_dsl"),
    ("internet_service", "'Fiber optic'", "internet_service_fiber_optic"),
    ("internet_service", "'No'", "internet_service_no"),
    ("online_security", "'No'", "online_security_no"), ("online_security", "'Yes'", "online_security_yes"),
    ("online_backup", "'No'", "online_backup_no"), ("online_backup", "'Yes'", "online_backup_yes"),
    ("device_protection", "'No'", "device_protection_no"),
    ("device_protection", "'Yes'", "device_protection_yes"),
    ("tech_support", "'No'", "tech_support_no"), ("tech_support", "'Yes'", "tech_support_yes"),
    ("streaming_tv", "'No'", "streaming_tv_no"), ("streaming_tv", "'Yes'", "streaming_tv_yes"),
    ("streaming_movies", "'No'", "streaming_movies_no"),
    ("streaming_movies", "'Yes'", "streaming_movies_yes"),
    ("contract", "'Month-to-month'", "contract_month_to_month"),
    ("contract", "'One year'", "contract_one_year"), ("contract", "'Two year'", "contract_two_year"),
    ("paperless_billing", "'No'", "paperless_billing_no"),
    ("paperless_billing", "'Yes'", "paperless_billing_yes"),
    ("payment_method", "'Bank transfer (automatic)'", "payment_method_bank_transfer_automatic"),
    ("payment_method", "'Credit card (automatic)'", "payment_method_credit_card_automatic"),
    ("payment_method", "'Electronic check'", "payment_method_electronic_check"),
    ("payment_method", "'Mailed check'", "payment_method_mailed_check"),
]

FEATURES_SQL = "SELECT customer_id, tenure, monthly_charges, total_charges,\n" \
    "  CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS churn,\n  " + ",\n  ".join(
        f"CASE WHEN {c} = {v} THEN 1 ELSE 0 END AS {n}" for c, v, n in ONEHOT_DOMAIN) + \
    "\nFROM silver WHERE total_charges IS NOT NULL"

FEATURE_COLUMNS = ["tenure", "monthly_charges", "total_charges", "churn"] + [n for _, _, n in ONEHOT_DOMAIN]

DASHBOARD_SQL = f"""
SELECT s.customer_id, s.prediction, f.churn, f.tenure, f.monthly_charges, f.total_charges,
  s.p_churn AS churn_probability,
  {bucket_sql("s.p_churn", RISK_BUCKETS, RISK_DEFAULT)} AS risk_category,
  CASE WHEN s.prediction = f.churn THEN 'Correct' ELSE 'Incorrect' END AS prediction_accuracy,
  f.monthly_charges * 12 AS revenue_impact,
  {bucket_sql("f.tenure", TENURE_BUCKETS, TENURE_DEFAULT)} AS tenure_category
FROM scores s JOIN features f ON s.customer_id = f.customer_id"""


def _silver_sql(sql: str, extra=None) -> str:
    return with_views(sql, ["subscribers"], [("silver", SILVER_SQL)] + (extra or []))


def _features_sql(sql: str, extra=None) -> str:
    return _silver_sql(sql, [("features", FEATURES_SQL)] + (extra or []))


def _dash_sql(sql: str) -> str:
    return with_views(sql, ["subscribers", "scores"],
                      [("silver", SILVER_SQL), ("features", FEATURES_SQL),
                       ("dash", DASHBOARD_SQL)])


def _round_all(cols: list[str]) -> str:
    return ", ".join(f"{r4(c)} AS {c}" for c in cols)


# ------------------------------------------------------------ ingest


@register("scan_subscribers", with_views("SELECT * FROM subscribers", ["subscribers"]))
def q_scan_subscribers(spark, sf_dir):
    return fx.subscribers(spark, sf_dir)


@register("clean_columns", with_views(
    "SELECT * EXCLUDE (mobile_number) FROM subscribers", ["subscribers"]))
def q_clean_columns(spark, sf_dir):
    """Subscribers under the raw CamelCase header, cleaned back to snake case."""
    s = fx.subscribers(spark, sf_dir).drop("mobile_number")
    raw = s.toDF(*ingest.RAW_CUSTOMER_HEADER)
    return ingest.clean_columns(raw)


@register("silver_customers", _silver_sql("SELECT * FROM silver"))
def q_silver_customers(spark, sf_dir):
    return silver(spark, sf_dir)


@register("silver_call_log", with_views(
    "SELECT * REPLACE (TRY_CAST(datatime AS TIMESTAMP) AS datatime) FROM call_log", ["call_log"]))
def q_silver_call_log(spark, sf_dir):
    return ingest.silver_call_log(fx.call_log(spark, sf_dir))


@register("customers_with_mobile", with_views(
    "SELECT s.* EXCLUDE (mobile_number), m.mobile_number FROM subscribers s "
    "LEFT JOIN customer_mobile m ON s.customer_id = m.customer_id",
    ["subscribers", "customer_mobile"]))
def q_customers_with_mobile(spark, sf_dir):
    customers = fx.subscribers(spark, sf_dir).drop("mobile_number")
    return ingest.attach_mobile(customers, fx.customer_mobile(spark, sf_dir))


@register("vertices", _silver_sql("SELECT * EXCLUDE (customer_id), customer_id AS id FROM silver"))
def q_vertices(spark, sf_dir):
    return ingest.vertices(silver(spark, sf_dir))


@register("csv_roundtrip", with_views("SELECT * FROM subscribers", ["subscribers"]))
def q_csv_roundtrip(spark, sf_dir):
    """Subscribers written as CSV with a header and read back with a schema."""
    path = scratch_path(spark, f"csv_roundtrip/{run_path(sf_dir)}")
    ingest.write_csv(fx.subscribers(spark, sf_dir), path)
    return ingest.read_csv(spark, path, ingest.CUSTOMER_SCHEMA)


def _source_files(spark, sf_dir) -> dict[str, DataFrame]:
    """The three source files written from the views and read back as bronze
    tables. Their columns stand in another order than the schemas', customers
    under the raw header. Lines that don't fit are added: every 50th customer
    again with a tenure that is no number, and the calls of every 100th caller
    again with such a duration."""
    base = scratch_path(spark, f"source_files/{run_path(sf_dir)}")
    s, calls = fx.subscribers(spark, sf_dir), fx.call_log(spark, sf_dir)
    raw = s.drop("mobile_number").toDF(*ingest.RAW_CUSTOMER_HEADER).withColumn("tenure", F.col("tenure").cast("string"))
    raw = raw.union(raw.where("cast(customerID as long) % 50 = 0").withColumn("tenure", F.lit("n/a")))
    ingest.write_csv(raw.select(*reversed(raw.columns)), f"{base}/customers")
    ingest.write_csv(fx.customer_mobile(spark, sf_dir).select("mobile_number", "customer_id"), f"{base}/mobile")
    log = calls.select("callee_mobile_number", F.col("duration").cast("string").alias("duration"), "caller_mobile_number", "datatime")
    log = log.union(log.where("cast(right(caller_mobile_number, 7) as long) % 100 = 0").withColumn("duration", F.lit("n/a")))
    ingest.write_csv(log, f"{base}/calls")
    return ingest.bronze_tables(spark, f"{base}/customers", f"{base}/mobile", f"{base}/calls")


@register("ingest_customers", _silver_sql("SELECT * FROM silver"))
def q_ingest_customers(spark, sf_dir):
    """Silver customers from the three source files, matched by header."""
    return ingest.layered_tables(_source_files(spark, sf_dir))["silver_customers"]


@register("ingest_edges", with_views("SELECT dst, src FROM edges", ["edges"]))
def q_ingest_edges(spark, sf_dir):
    """Call edges from the three source files."""
    return ingest.layered_tables(_source_files(spark, sf_dir))["edges"].select("dst", "src")


@register("ingest_quarantine", with_views("""
SELECT 'customers' AS source, count(*) AS bad_rows FROM subscribers WHERE CAST(customer_id AS BIGINT) % 50 = 0
UNION ALL SELECT 'call_log', count(*) FROM call_log WHERE CAST(right(caller_mobile_number, 7) AS BIGINT) % 100 = 0""",
    ["subscribers", "call_log"]))
def q_ingest_quarantine(spark, sf_dir):
    """Lines of the source files that don't fit, counted per file."""
    return ingest.quarantine_counts(_source_files(spark, sf_dir)["quarantine"])


@register("table_roundtrip", _silver_sql("SELECT * FROM silver"))
def q_table_roundtrip(spark, sf_dir):
    """Silver customers saved as a (replaced) table and read back."""
    ingest.ensure_schema(spark, "churnlens")
    name = f"churnlens.silver_customers_{run_path(sf_dir)}"
    path = scratch_path(spark, f"tables/{name}")
    ingest.write_table(silver(spark, sf_dir), name, path)
    return ingest.read_table(spark, name)


# ------------------------------------------------------------ features


@register("category_vocabulary", _silver_sql(" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM silver "
    f"WHERE {c} IS NOT NULL" for c in onehot.CATEGORICAL_COLUMNS)))
def q_category_vocabulary(spark, sf_dir):
    return onehot.category_vocabulary(silver(spark, sf_dir))


@register("onehot_features", _features_sql(
    f"SELECT * REPLACE ({_round_all(['monthly_charges', 'total_charges'])}) FROM features"))
def q_onehot_features(spark, sf_dir):
    return rounded(customer_features(spark, sf_dir))


@register("describe_features", _features_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS count, "
    f"{r4(f'avg(CAST({c} AS DOUBLE))')} AS mean, {r4(f'stddev_samp(CAST({c} AS DOUBLE))')} AS stddev, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM features"
    for c in FEATURE_COLUMNS)))
def q_describe_features(spark, sf_dir):
    return rounded(profile.describe_numeric(customer_features(spark, sf_dir)))


@register("null_profile", _silver_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver"
    for c in ingest.CUSTOMER_COLUMNS)))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(silver(spark, sf_dir))


@register("target_distribution", _features_sql(f"""
SELECT churn, count(*) AS count,
  {r4("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM features)")} AS percentage
FROM features GROUP BY churn"""))
def q_target_distribution(spark, sf_dir):
    return rounded(profile.target_distribution(customer_facts(spark, sf_dir)))


@register("feature_pk_violations", _features_sql("""
SELECT customer_id, count(*) AS n FROM features GROUP BY customer_id
HAVING count(*) > 1 OR customer_id IS NULL"""))
def q_feature_pk_violations(spark, sf_dir):
    from churnlens.sources.feature_table import key_violations
    return key_violations(customer_facts(spark, sf_dir), ["customer_id"])


@register("hist_payment_churn", _silver_sql("""
SELECT payment_method, churn, count(*) AS count,
  CAST(sum(count(*)) OVER (PARTITION BY payment_method) AS BIGINT) AS category_total
FROM silver GROUP BY payment_method, churn"""))
def q_hist_payment_churn(spark, sf_dir):
    return profile.category_histogram(silver(spark, sf_dir), "payment_method", "churn")


@register("contract_share", _silver_sql(f"""
SELECT contract, count(*) AS count,
  {r4("count(*) / CAST((SELECT count(*) FROM silver) AS DOUBLE)")} AS share
FROM silver GROUP BY contract"""))
def q_contract_share(spark, sf_dir):
    return rounded(profile.share(silver(spark, sf_dir), "contract"))


@register("hist_tenure_churn", _silver_sql("""
SELECT floor(tenure / CAST(6 AS DOUBLE)) * CAST(6 AS DOUBLE) AS bin_start, churn, count(*) AS count
FROM silver GROUP BY 1, 2"""))
def q_hist_tenure_churn(spark, sf_dir):
    return profile.numeric_histogram(silver(spark, sf_dir), "tenure", "churn", 6.0)


@register("bootstrap_sample")
def q_bootstrap_sample(spark, sf_dir):
    """10,000 rows drawn with replacement (seed 123); rows-only."""
    return profile.bootstrap_sample(silver(spark, sf_dir), 10000, 123)


# ------------------------------------------------------------ gold

_DASH_COLS = ["customer_id", "prediction", "churn", "tenure", "monthly_charges",
              "total_charges", "churn_probability", "risk_category",
              "prediction_accuracy", "revenue_impact", "tenure_category"]


@register("dashboard_rows", _dash_sql(
    f"SELECT * REPLACE ({_round_all(['monthly_charges', 'total_charges', 'churn_probability', 'revenue_impact'])}) FROM dash"))
def q_dashboard_rows(spark, sf_dir):
    """The gold table without the probability array (it equals
    [1 - churn_probability, churn_probability])."""
    return rounded(dashboard(spark, sf_dir).select(_DASH_COLS))


@register("risk_distribution", _dash_sql(f"""
SELECT risk_category, count(*) AS customer_count,
  {r4("avg(churn_probability)")} AS avg_churn_probability,
  {r4("avg(monthly_charges)")} AS avg_monthly_charges
FROM dash GROUP BY risk_category"""))
def q_risk_distribution(spark, sf_dir):
    return rounded(dash.risk_distribution(dashboard(spark, sf_dir)))


@register("tenure_risk", _dash_sql(f"""
SELECT tenure_category, risk_category, count(*) AS customer_count,
  {r4("avg(churn_probability)")} AS avg_churn_probability,
  {r4("sum(revenue_impact)")} AS total_revenue_impact
FROM dash GROUP BY tenure_category, risk_category"""))
def q_tenure_risk(spark, sf_dir):
    return rounded(dash.tenure_risk(dashboard(spark, sf_dir)))


@register("revenue_at_risk", _dash_sql(f"""
SELECT count(*) AS customers_at_risk, {r4("sum(revenue_impact)")} AS revenue_at_risk,
  {r4("avg(churn_probability)")} AS avg_churn_probability
FROM dash WHERE risk_category IN ('High Risk', 'Medium Risk')"""))
def q_revenue_at_risk(spark, sf_dir):
    return rounded(dash.revenue_at_risk(dashboard(spark, sf_dir)))


@register("confidence_analysis", _dash_sql(f"""
SELECT {bucket_sql("churn_probability", CONFIDENCE_BUCKETS, CONFIDENCE_DEFAULT)} AS confidence_level,
  count(*) AS customer_count, {r4("avg(churn_probability)")} AS avg_churn_probability,
  {r4("avg(monthly_charges)")} AS avg_monthly_charges
FROM dash GROUP BY 1"""))
def q_confidence_analysis(spark, sf_dir):
    return rounded(dash.confidence_analysis(dashboard(spark, sf_dir)))


@register("kpi_summary", _dash_sql(f"""
SELECT count(*) AS total_customers,
  count(*) FILTER (WHERE churn = 1) AS churned_customers,
  {r4("count(*) FILTER (WHERE churn = 1) / CAST(count(*) AS DOUBLE)")} AS churn_rate,
  count(*) FILTER (WHERE prediction = 1) AS predicted_churned,
  {r4("count(*) FILTER (WHERE prediction_accuracy = 'Correct') / CAST(count(*) AS DOUBLE)")} AS prediction_accuracy,
  count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_customers,
  count(*) FILTER (WHERE risk_category = 'Medium Risk') AS medium_risk_customers,
  {r4("avg(churn_probability)")} AS avg_churn_probability,
  {r4("sum(revenue_impact)")} AS total_revenue
FROM dash"""))
def q_kpi_summary(spark, sf_dir):
    return rounded(dash.kpi_summary(dashboard(spark, sf_dir)))


@register("dashboard_csv", _dash_sql(
    f"SELECT * REPLACE ({_round_all(['monthly_charges', 'total_charges', 'churn_probability', 'revenue_impact'])}), "
    f"{r4('1 - churn_probability')} AS probability_0, {r4('churn_probability')} AS probability_1 FROM dash"))
def q_dashboard_csv(spark, sf_dir):
    """The gold table exported to CSV (probability flattened) and read back."""
    from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                                   StructType)
    path = scratch_path(spark, f"dashboard_csv/{run_path(sf_dir)}")
    ingest.write_csv(dashboard(spark, sf_dir), path, {"probability": 2})
    schema = StructType([
        StructField("customer_id", StringType()), StructField("prediction", IntegerType()),
        StructField("probability_0", DoubleType()), StructField("probability_1", DoubleType()),
        StructField("churn", IntegerType()), StructField("tenure", IntegerType()),
        StructField("monthly_charges", DoubleType()), StructField("total_charges", DoubleType()),
        StructField("churn_probability", DoubleType()), StructField("risk_category", StringType()),
        StructField("prediction_accuracy", StringType()), StructField("revenue_impact", DoubleType()),
        StructField("tenure_category", StringType())])
    return rounded(ingest.read_csv(spark, path, schema))
