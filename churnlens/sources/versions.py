"""Tables that are replaced without a gap.

A table's rows lie in a version folder of their own. Replacing it writes a new
folder, checks what was written, and only then points the table at it: a write
that fails leaves the table as it was, and so does a check that does. The
version before stays readable under its folder, which the table's property
``previous_location`` names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PREVIOUS = "previous_location"


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _home(spark: SparkSession, name: str, path: str | None) -> str:
    """The folder of the versions of a table."""
    return (path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions/{name.replace('`', '')}").rstrip("/")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_table(df: DataFrame, name: str, path: str | None = None,
                  check: Callable[[DataFrame], None] | None = None) -> int:
    """Make ``df`` the rows and columns of table ``name``; returns its row count.

    ``check`` sees the written version and raises to refuse it. ``df`` is
    computed once, and may read the table itself. Properties and the comment of
    the table stay.
    """
    spark = df.sparkSession
    new = f"{_home(spark, name, path)}/v-{uuid.uuid4().hex}"
    df.write.parquet(new)
    written = spark.read.schema(df.schema).parquet(new)
    n = written.count()
    if check:
        check(written)
    if not spark.catalog.tableExists(name):
        _create(spark, name, df, new)
        return n
    old = location(spark, name)
    same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(new)}")
    else:  # the columns differ: the new table takes the name, which is a change of the catalog only
        keep = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        comment = spark.catalog.getTable(name).description
        aside, ahead = f"{name}_{uuid.uuid4().hex[:8]}", f"{name}_{uuid.uuid4().hex[:8]}"
        _create(spark, ahead, df, new)
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {ahead} RENAME TO {name}")
        spark.sql(f"DROP TABLE {aside}")
        set_properties(spark, name, {k: v for k, v in keep.items() if not k.startswith(("spark.", "transient"))}, comment)
    spark.catalog.refreshTable(name)
    set_properties(spark, name, {PREVIOUS: old})
    return n


def _create(spark: SparkSession, name: str, df: DataFrame, folder: str) -> None:
    spark.catalog.createTable(name, path=folder, source="parquet", schema=df.schema)


def set_properties(spark: SparkSession, name: str, properties: dict[str, str], comment: str | None = None) -> None:
    if properties:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{_quoted(k)} = {_quoted(v)}' for k, v in properties.items())})")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")


def previous_version(spark: SparkSession, name: str) -> DataFrame | None:
    """The rows that the last replacement put aside; None before the first."""
    at = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(PREVIOUS)
    return spark.read.parquet(at) if at else None
