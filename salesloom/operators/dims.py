"""Dimension builds from the product staging table and the transactions.

``dim_product``/``dim_supplier``/``dim_store`` are the three
``INSERT ... SELECT DISTINCT ... WHERE id IS NOT NULL`` loads; of rows that share
an id the smallest is kept (the product lookup's rule), so a repeated id never
multiplies the fact rows that join it; :func:`dim_rejects` are the other rows.  The time
dimension takes, per timeID, the first row (by arrival) whose timestamp
parses, and a merge keeps rows already stored (insert-if-absent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import left_lookup
from salesloom.schemas import TIME_COLUMNS
from salesloom.sources.transactions import time_rows

DIM_COLUMNS = {"product": ["productID", "productName", "productPrice"],
               "supplier": ["supplierID", "supplierName"], "store": ["storeID", "storeName"]}
NULL_KEY, REPEATED_KEY = "null_key", "repeated_key"


def _distinct_where(staging: DataFrame, key: str, cols: list[str]) -> DataFrame:
    rest = [c for c in cols if c != key]
    one = staging.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_one"))
    return one.select(*[F.col(c) if c == key else F.col(f"_one.{c}").alias(c) for c in cols])


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the smallest row of each ``key`` (rows without key are dropped)."""
    return _distinct_where(rows, key, rows.columns)


def dim_candidates(staging: DataFrame, dim: str) -> DataFrame:
    """The distinct rows of staging that ``dim`` is reduced from, without key as well."""
    return staging.select(*DIM_COLUMNS[dim]).distinct()


def dim_rejects(rows: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows that :func:`one_per_key` leaves out, one by one, with ``reject_reason``:
    those without key and, of each key, all but one copy of the row in ``kept``."""
    one = F.struct(*[c for c in rows.columns if c != key])
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    out = (left_lookup(counted, kept.select(key, one.alias("_kept")), key)     # a null key has no match
           .withColumn("_copies", F.col("_copies") - F.col("_kept").eqNullSafe(one).cast("bigint"))
           .where(F.col("_copies") > 0)
           .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))))
    reason = F.when(F.col(key).isNull(), NULL_KEY).otherwise(REPEATED_KEY)
    return out.select(reason.alias("reject_reason"), *rows.columns)


def dim_product(staging: DataFrame) -> DataFrame:
    return _distinct_where(staging, "productID", DIM_COLUMNS["product"])


def dim_supplier(staging: DataFrame) -> DataFrame:
    return _distinct_where(staging, "supplierID", DIM_COLUMNS["supplier"])


def dim_store(staging: DataFrame) -> DataFrame:
    return _distinct_where(staging, "storeID", DIM_COLUMNS["store"])


def dim_time(candidates: DataFrame) -> DataFrame:
    """Time_Dimension rows from ``timeID, orderTS, arrival`` candidates."""
    return time_rows(candidates).select(*TIME_COLUMNS)


def merge_time_dim(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-if-absent: a timeID already stored keeps its stored row."""
    fresh = new.join(existing.select("timeID"), "timeID", "left_anti")
    return existing.select(*TIME_COLUMNS).unionByName(fresh.select(*TIME_COLUMNS))
