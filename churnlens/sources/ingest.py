"""Bronze/silver ingest: CSV and table I/O, column-name cleanup, type repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType,
                               StructField, StructType)

from churnlens.functions.names import snake_name
from churnlens.sources.versions import replace_table

# Column order of the bronze customer table (notebook 01).
CUSTOMER_COLUMNS = [
    "customer_id", "gender", "senior_citizen", "partner", "dependents",
    "tenure", "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection", "tech_support",
    "streaming_tv", "streaming_movies", "contract", "paperless_billing",
    "payment_method", "monthly_charges", "total_charges", "mobile_number", "churn",
]

# Header of the public Telco customer-churn CSV (before cleanup).
RAW_CUSTOMER_HEADER = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

CUSTOMER_SCHEMA = StructType(
    [StructField(c, StringType()) for c in CUSTOMER_COLUMNS[:2]]
    + [StructField("senior_citizen", IntegerType())]
    + [StructField(c, StringType()) for c in CUSTOMER_COLUMNS[3:5]]
    + [StructField("tenure", IntegerType())]
    + [StructField(c, StringType()) for c in CUSTOMER_COLUMNS[6:18]]
    + [StructField("monthly_charges", DoubleType()),
       StructField("total_charges", StringType()),
       StructField("mobile_number", StringType()),
       StructField("churn", StringType())])

CALL_LOG_SCHEMA = StructType([
    StructField("datatime", StringType()),
    StructField("caller_mobile_number", StringType()),
    StructField("callee_mobile_number", StringType()),
    StructField("duration", IntegerType()),
])

MOBILE_SCHEMA = StructType([StructField("customer_id", StringType()),
                            StructField("mobile_number", StringType())])


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename all columns at once (names are computed on the driver)."""
    return df.toDF(*[snake_name(c) for c in df.columns])


# ----------------------------------------------------------------- CSV I/O

_CSV_OPTS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false", "nullValue": "",
             "emptyValue": "\"\"", "mode": "FAILFAST"}


#: Holds a line that doesn't fit while it is read.
CORRUPT = "_corrupt_record"


def _matched(spark: SparkSession, path: str, schema: StructType) -> tuple[StructType, dict[str, str]]:
    """The file's own columns in its order, with the types of ``schema`` where
    the names agree, as they stand or cleaned; and schema name -> header name.
    Only the first line is parsed."""
    header, found = spark.read.option("header", "true").csv(path).columns, {}
    wanted = set(schema.names)
    for raw in header:
        name = raw if raw in wanted else snake_name(raw)
        if name not in wanted:
            continue
        if name in found:
            raise ValueError(f"columns {found[name]!r} and {raw!r} of {path} are both {name}")
        found[name] = raw
    missing = [n for n in schema.names if n not in found]
    if missing:
        raise ValueError(f"columns {missing} are missing in {path}, its header is {header}")
    types = {found[f.name]: f.dataType for f in schema}
    return StructType([StructField(raw, types.get(raw, StringType())) for raw in header]), found


def _read(spark: SparkSession, path: str, whole: StructType, mode: str) -> DataFrame:
    # enforceSchema=false: a part file whose header differs from the first one's is an error
    opts = {**_CSV_OPTS, "mode": mode, "enforceSchema": "false", "columnNameOfCorruptRecord": CORRUPT}
    return spark.read.options(**opts).schema(whole).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).

    Columns are matched by header name, in any order; a missing one is an error,
    others are left out. A value that doesn't fit its type is an error.
    Whitespace is kept, so a blank ``total_charges`` stays ``' '`` and is
    repaired by the silver cast, as with the reference's pandas reader.
    """
    whole, found = _matched(spark, path, schema)
    return _read(spark, path, whole, "FAILFAST").select([F.col(f"`{found[f.name]}`").alias(f.name) for f in schema])


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV file that fit ``schema`` (matched as by ``read_csv``),
    and the quarantine: lines with too few or too many fields, or with a value
    that its type can't hold, as (source, record, file).

    Both read the files when used; together they hold every line. A missing
    column is no bad row but an error.
    """
    whole, found = _matched(spark, path, schema)
    rows = _read(spark, path, StructType([*whole, StructField(CORRUPT, StringType())]), "PERMISSIVE")
    # the parser judges the columns that are read: the first condition, true of all rows, reads them all. With the row's
    # number in it, it is no constraint for the optimiser, which would hold it with every choice of renamed columns (2^20)
    every = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in whole.names], F.monotonically_increasing_id()), F.lit(1)) == 0
    good = rows.where(every & F.col(CORRUPT).isNull()).select([F.col(f"`{found[f.name]}`").alias(f.name) for f in schema])
    bad = rows.where(every & F.col(CORRUPT).isNotNull()).select(
        F.lit(source or path).alias("source"), F.col(CORRUPT).alias("record"), F.input_file_name().alias("file"))
    return good, bad


def write_csv(df: DataFrame, path: str, array_lengths: dict[str, int] | None = None) -> None:
    """Write CSV with a header. The CSV source rejects arrays: a column named
    in ``array_lengths`` is flattened to ``<name>_<i>`` for its whole length,
    any other array is one JSON column.

    An array that is longer or shorter than given is an error, so no element
    is ever lost.
    """
    lengths = array_lengths or {}
    cols = []
    for f in df.schema.fields:
        if not isinstance(f.dataType, ArrayType):
            cols.append(F.col(f.name))
        elif f.name in lengths:
            n = lengths[f.name]
            whole = F.when(F.col(f.name).isNull() | (F.size(f.name) == n), F.col(f.name)).otherwise(
                F.raise_error(F.lit(f"an array of column {f.name} has not {n} elements")).cast(f.dataType))
            cols += [F.get(whole, F.lit(i)).alias(f"{f.name}_{i}") for i in range(n)]
        else:
            cols.append(F.to_json(f.name).alias(f.name))
    (df.select(cols).write.mode("overwrite")
     .options(**{k: v for k, v in _CSV_OPTS.items() if k != "mode"})
     .csv(path))


# --------------------------------------------------------------- tables

def write_table(df: DataFrame, name: str, path: str | None = None) -> int:
    """Replace table ``name`` (schema included) and return its row count.

    Versions lie under ``path`` (a shared folder) or the session's warehouse;
    the table moves to the new one when that is whole (``versions``).
    """
    return replace_table(df, name, path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")


def current_namespace(spark: SparkSession) -> tuple[str, str]:
    """Catalog and schema that unqualified names refer to."""
    return tuple(spark.sql("SELECT current_catalog(), current_schema()").first())


def use_schema(spark: SparkSession, schema: str) -> str:
    """Switch the current namespace and return it as read back."""
    spark.catalog.setCurrentDatabase(schema)
    return spark.sql("SELECT current_schema()").first()[0]


# --------------------------------------------------------------- silver

def silver_customers(bronze: DataFrame) -> DataFrame:
    """``total_charges`` string -> double; unparsable (blank) becomes null."""
    return bronze.withColumn("total_charges", F.col("total_charges").try_cast("double"))


def silver_call_log(bronze: DataFrame) -> DataFrame:
    """``datatime`` ISO-8601 string -> wall-clock UTC ``timestamp_ntz`` (null if
    bad), the same in any session time zone.

    A string with a zone (``Z`` or an offset) is an instant, shown in UTC; one
    without is taken as it stands.
    """
    text = F.col("datatime")
    zone = F.current_timezone()
    instant = F.to_utc_timestamp(F.try_to_timestamp(text), zone)
    value = F.when(text.rlike(r"(?i)(?:z|utc|[+-]\d{1,2}:?\d{2})\s*$") & text.rlike(r"\d:\d"), instant.cast("timestamp_ntz")).otherwise(
        text.try_cast("timestamp_ntz"))
    return bronze.withColumn("datatime", value)


def attach_mobile(customers: DataFrame, mobile: DataFrame) -> DataFrame:
    """Customers left-joined to their mobile numbers on ``customer_id``."""
    return customers.join(mobile, "customer_id", "left")


def vertices(silver: DataFrame) -> DataFrame:
    return silver.withColumnRenamed("customer_id", "id")


def bronze_tables(spark: SparkSession, customer_csv: str, mobile_csv: str, call_log_csv: str) -> dict[str, DataFrame]:
    """The three source files through their schemas, by cleaned header names:
    customers (without the number), their numbers, and the call log; and
    ``quarantine``, the lines of all three that don't fit."""
    customers = StructType([f for f in CUSTOMER_SCHEMA if f.name != "mobile_number"])
    out, bad = {}, None
    for name, path, schema in (("customers", customer_csv, customers), ("mobile", mobile_csv, MOBILE_SCHEMA),
                               ("call_log", call_log_csv, CALL_LOG_SCHEMA)):
        out[name], held = read_csv_checked(spark, path, schema, name)
        bad = held if bad is None else bad.union(held)
    return {**out, "quarantine": bad}


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """How many lines of each source are in the quarantine."""
    return quarantine.groupBy("source").agg(F.count(F.lit(1)).alias("bad_rows"))


def layered_tables(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Bronze -> silver customers and calls, graph vertices and edges."""
    from churnlens.operators.edges import build_edges
    silver = silver_customers(attach_mobile(bronze["customers"], bronze["mobile"]))
    calls = silver_call_log(bronze["call_log"])
    return {"silver_customers": silver, "silver_call_log": calls, "vertices": vertices(silver),
            "edges": build_edges(calls, silver)}
