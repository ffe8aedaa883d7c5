"""Additive upsert of the sales fact, expressed as an aggregation.

``INSERT ... ON DUPLICATE KEY UPDATE q = q + new.q, t = t + new.t`` over a
sequence of rows equals, per primary key (orderID, productID, customerID):
the sum of quantities, the sum of amounts, and the non-additive columns
(supplierID, storeID, orderDate, timeID) of the first row to arrive.  Sums
commute, so the result does not depend on how rows are split into batches
or in which order batches land; only ``arrival`` decides the kept columns.

The aggregate combines partially on the map side, so a very hot key costs
one row per map task in the shuffle; loads of whole ledgers, where few keys repeat, deal
the rows to tasks by key instead (``tasks``).  Sums are wide; a key whose total does not
fit the fact's types is kept out of the fact and listed by
:func:`overflowed_keys` with its whole total, and the other keys load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.schemas import MONEY, WIDE_MONEY

FACT_KEY = ["orderID", "productID", "customerID"]


OVERFLOW = "amount_overflow"


def fact_totals(rows: DataFrame, extra_keys: list | None = None, tasks: int | None = None) -> DataFrame:
    """One row per key with wide sums, from enriched rows or from a ledger of them.

    The first row's columns make this an aggregate by sorting.  With ``tasks`` the rows are
    dealt to so many by key and sorted once there, in memory; without, every map task sorts all its rows
    before the shuffle as well, which saves nothing where few keys repeat.

    ``extra_keys`` (Columns) are added to the grouping and kept in the
    output, e.g. an event-time window for a watermarked streaming state.
    """
    first = F.min_by(F.struct("supplierID", "storeID", "orderDate", "timeID"), F.col("arrival"))
    if tasks:
        rows = rows.repartition(tasks, *FACT_KEY)
    agg = (rows.groupBy(*FACT_KEY, *(extra_keys or []))
           .agg(first.alias("_first"),
                F.sum(F.col("quantityOrdered").cast("bigint")).alias("quantityOrdered"),
                F.sum(F.col("totalSale").cast(WIDE_MONEY)).cast(WIDE_MONEY).alias("totalSale")))
    kept = [c for c in agg.columns if c not in FACT_KEY and c not in
            ("_first", "quantityOrdered", "totalSale")]
    return agg.select(*FACT_KEY, "_first.supplierID", "_first.storeID", "_first.orderDate",
                      "_first.timeID", "quantityOrdered", "totalSale", *kept)


def overflows() -> Column:
    """Whether a total does not fit the fact's types (a null amount does)."""
    return F.coalesce((F.col("quantityOrdered").try_cast("int").isNull() & F.col("quantityOrdered").isNotNull())
                      | (F.col("totalSale").try_cast(MONEY).isNull() & F.col("totalSale").isNotNull()),
                      F.lit(False))


def fitting(totals: DataFrame) -> DataFrame:
    """The totals that fit, in the fact's types."""
    return (totals.where(~overflows())
            .withColumn("quantityOrdered", F.col("quantityOrdered").try_cast("int"))
            .withColumn("totalSale", F.col("totalSale").try_cast(MONEY)))


def collapse_fact(rows: DataFrame, extra_keys: list | None = None, tasks: int | None = None) -> DataFrame:
    """Sales_FactTable rows from enriched rows or from a ledger of them (see
    :func:`fact_totals`); keys whose total overflows are left to :func:`overflowed_keys`."""
    return fitting(fact_totals(rows, extra_keys, tasks))


def overflowed_keys(totals: DataFrame) -> DataFrame:
    """The totals that do not fit, wide, with a ``reject_reason``."""
    return totals.where(overflows()).withColumn("reject_reason", F.lit(OVERFLOW))
