"""Call log -> directed customer edges (dst, src), distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def number_lookup(customers: DataFrame) -> DataFrame:
    """mobile_number -> customer_id, null numbers removed (they never match)."""
    return (customers.where(F.col("mobile_number").isNotNull())
            .select("mobile_number", "customer_id"))


def build_edges(calls: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct (dst, src) customer pairs over the call log.

    Both ends are resolved with left joins, so an off-network number gives a
    null end (kept, as in the reference). Calls are first reduced to distinct
    (caller, callee) number pairs: the joins are many-to-one lookups, so this
    gives the same distinct result while shuffling each pair once instead of
    once per call. A callee number that receives a large share of calls is a
    hot join key; AQE's skew-join split handles it because the lookup side has
    one row per number.
    """
    pairs = (calls.select("caller_mobile_number", "callee_mobile_number")
             .distinct())
    lookup = number_lookup(customers)
    src = lookup.select(F.col("mobile_number").alias("caller_mobile_number"),
                        F.col("customer_id").alias("src"))
    dst = lookup.select(F.col("mobile_number").alias("callee_mobile_number"),
                        F.col("customer_id").alias("dst"))
    return (pairs.join(src, "caller_mobile_number", "left")
            .join(dst, "callee_mobile_number", "left")
            .select("dst", "src")
            .distinct())
