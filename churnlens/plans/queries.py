"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with oracle SQL.

Each query reads the supplied tables (through the derived views in
``churnlens.sources.fixtures``) and returns a lazy DataFrame. Double columns
that are compared with the oracle are rounded with ``round4`` on both sides
(SURVEY decision D7); the library functions themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from churnlens.functions.columns import round4
from churnlens.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column for comparison (D7)."""
    return df.select([
        round4(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


#: Decimals kept of metrics that shrink as 1 / n.
FINE = 11


def rounded_fine(df: DataFrame, columns: list[str]) -> DataFrame:
    """Round the named columns to FINE decimals, other doubles as ``rounded``."""
    return df.select([
        F.round(f.name, FINE).alias(f.name) if f.name in columns
        else round4(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def r11(expr: str) -> str:
    """The FINE rounding as SQL text."""
    return f"round(CAST({expr} AS DOUBLE), {FINE})"


def r4(expr: str) -> str:
    """The D7 rounding as SQL text."""
    return f"floor(({expr}) * CAST(10000 AS DOUBLE) + CAST(0.500001 AS DOUBLE)) / CAST(10000 AS DOUBLE)"


# Register the query modules (import order = registration order).
from churnlens.plans import q_relational  # noqa: E402,F401
from churnlens.plans import q_graph  # noqa: E402,F401
from churnlens.plans import q_model  # noqa: E402,F401
