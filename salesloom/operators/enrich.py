"""Enrichment of typed transactions with the product master, and quarantine.

For every transaction: look up the product (price, supplier, store); the
product's supplier and store must exist in their dimensions; the customer
must exist; ``quantity * price`` must fit DECIMAL(10,2).  The first failing
rule names the ``reject_reason``:

    product_not_found, invalid_supplier, invalid_store,
    customer_not_found, amount_overflow

Supplier and store validity depend only on the product, so they are
resolved once on the product master (a table of products, not of
transactions): the transaction stream meets two lookups, product and
customer, instead of four.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.joins import join_dim, left_lookup
from salesloom.schemas import FACT_COLUMNS, MONEY

REASONS = ("product_not_found", "invalid_supplier", "invalid_store",
           "customer_not_found", "amount_overflow")


def customer_keys(customers: DataFrame) -> DataFrame:
    """Distinct customer ids with the ``_customer_ok`` marker."""
    return _keys(customers, "customerID", "_customer_ok")


def _keys(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct non-null keys with a TRUE marker (never duplicates a row)."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().withColumn(flag, F.lit(True))


def product_master(staging: DataFrame, suppliers: DataFrame, stores: DataFrame,
                   rows: dict | None = None) -> DataFrame:
    """One row per productID: price, supplier, store and their validity.

    A duplicated productID keeps its smallest (name, price, supplier, store)
    so that the lookup is deterministic.
    """
    rows = rows or {}
    one = (staging.where(F.col("productID").isNotNull())
           .groupBy("productID")
           .agg(F.min(F.struct("productName", "productPrice", "supplierID", "storeID")).alias("m"))
           .select("productID", F.col("m.productPrice").alias("productPrice"),
                   F.col("m.supplierID").alias("supplierID"), F.col("m.storeID").alias("storeID")))
    one = join_dim(one, _keys(suppliers, "supplierID", "_supplier_ok"), "supplierID", "left",
                   rows.get("supplier"))
    one = join_dim(one, _keys(stores, "storeID", "_store_ok"), "storeID", "left",
                   rows.get("store"))
    return one.select("productID", "productPrice", "supplierID", "storeID",
                      F.coalesce("_supplier_ok", F.lit(False)).alias("_supplier_ok"),
                      F.coalesce("_store_ok", F.lit(False)).alias("_store_ok"),
                      F.lit(True).alias("_product_ok"))


PASS_THROUGH = ("orderTS", "raw", "time_ok")


def enrich_transactions(parsed: DataFrame, staging: DataFrame, suppliers: DataFrame,
                        stores: DataFrame, customers: DataFrame, rows: dict | None = None,
                        max_broadcast_rows: int | None = None) -> DataFrame:
    """Fact columns + ``arrival`` + ``reject_reason`` for every parsed row.

    ``parsed`` needs orderID, productID, quantityOrdered, customerID,
    orderTS (or orderDate), timeID and optionally arrival.  A row the parser
    already rejected keeps its parse reason; ``orderTS``, ``raw`` and
    ``time_ok`` are carried through when present, so one written ledger
    holds the fact rows, the rejects and the time candidates.
    Batch or streaming input; the masters are static DataFrames.
    """
    rows = rows or {}
    return enrich_with_masters(parsed, product_master(staging, suppliers, stores, rows),
                               customer_keys(customers), rows, max_broadcast_rows)


def enrich_with_masters(parsed: DataFrame, master: DataFrame, cust_keys: DataFrame,
                        rows: dict | None = None,
                        max_broadcast_rows: int | None = None) -> DataFrame:
    """:func:`enrich_transactions` against prepared lookups: a
    :func:`product_master` and :func:`customer_keys` (e.g. written once by
    the warehouse load and read by every stream micro-batch)."""
    rows = rows or {}
    t = parsed
    prior = F.col("reject_reason") if "reject_reason" in t.columns else F.lit(None).cast("string")
    t = t.withColumn("_prior_reason", prior)
    if "reject_reason" in t.columns:
        t = t.drop("reject_reason")
    if "orderDate" not in t.columns:
        t = t.withColumn("orderDate", F.to_date("orderTS"))
    if "arrival" not in t.columns:
        t = t.withColumn("arrival", F.struct(F.col("orderTS").alias("ts")))
    # rows that the parser rejected have null keys
    t = left_lookup(t, master, "productID", rows.get("product"), max_broadcast_rows)
    t = left_lookup(t, cust_keys, "customerID", rows.get("customer"), max_broadcast_rows)
    amount = (F.col("quantityOrdered") * F.coalesce(F.col("productPrice"), F.lit(0).cast(MONEY)))
    total = amount.try_cast(MONEY)
    reason = (F.when(F.col("_prior_reason").isNotNull(), F.col("_prior_reason"))
              .when(F.col("_product_ok").isNull(), F.lit(REASONS[0]))
              .when(~F.col("_supplier_ok"), F.lit(REASONS[1]))
              .when(~F.col("_store_ok"), F.lit(REASONS[2]))
              .when(F.col("_customer_ok").isNull(), F.lit(REASONS[3]))
              .when(total.isNull() & amount.isNotNull(), F.lit(REASONS[4])))
    extra = [c for c in PASS_THROUGH if c in t.columns]
    return t.select("orderID", "productID", "customerID", "supplierID", "storeID",
                    "orderDate", "timeID", "quantityOrdered", total.alias("totalSale"),
                    "arrival", *extra, reason.alias("reject_reason"))


def accepted_facts(enriched: DataFrame) -> DataFrame:
    extra = [c for c in PASS_THROUGH if c in enriched.columns]
    return enriched.where(F.col("reject_reason").isNull()).drop("reject_reason", *extra)


def fact_rejects(enriched: DataFrame) -> DataFrame:
    """The quarantine side of :func:`enrich_transactions`."""
    raw = [F.col("raw")] if "raw" in enriched.columns else []
    return (enriched.where(F.col("reject_reason").isNotNull())
            .select(*FACT_COLUMNS, *raw, "reject_reason"))
