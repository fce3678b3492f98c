"""Feature tables: a Parquet table with a primary key and a description.

Replaces the hosted feature-store client: the key and description are kept
as table properties and a comment, and the key is checked with one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.versions import location, replace_table, set_properties


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are null or appear more than once (empty when valid)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | null_key))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _checked(name: str, keys: list[str]):
    """Refuses a written version whose key is null or repeated."""
    def check(written: DataFrame) -> None:
        if keys and not key_violations(written, keys).isEmpty():
            raise ValueError(f"primary key {keys} of {name} is null or not unique")
    return check


def create_table(spark: SparkSession, name: str, df: DataFrame, primary_keys: list[str],
                 description: str, path: str | None = None) -> int:
    """Replace feature table ``name`` with ``df``, written as a new version and
    checked there, so ``df`` is computed once.

    Returns the row count. Raises if a key value is null or repeated; the table
    is then as it was.
    """
    n = replace_table(df, name, path, _checked(name, primary_keys))
    set_properties(spark, name, {"primary_keys": ",".join(primary_keys)}, description)
    return n


def write_table(spark: SparkSession, name: str, df: DataFrame) -> int:
    """Replace the rows of an existing feature table, keeping its properties.

    Columns are matched by name; missing or extra ones are an error, and so is
    a null or repeated key; the table is then as it was.
    """
    columns = spark.table(name).columns
    if set(df.columns) != set(columns) or len(df.columns) != len(columns):
        raise ValueError(f"columns of {name} are {columns}, given are {df.columns}")
    rows = df.select([F.col(f.name).cast(f.dataType) for f in spark.table(name).schema])
    home = location(spark, name).rsplit("/", 1)[0]
    return replace_table(rows, name, home, _checked(name, get_table(spark, name)["primary_keys"]))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def get_table(spark: SparkSession, name: str) -> dict:
    """Name, primary keys and description of a feature table."""
    props = {r["key"]: r["value"] for r in
             spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    keys = [k for k in props.get("primary_keys", "").split(",") if k]
    desc = spark.catalog.getTable(name).description or ""
    return {"name": name, "primary_keys": keys, "description": desc}
