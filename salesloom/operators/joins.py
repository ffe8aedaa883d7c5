"""Dimension joins with a checked broadcast.

A dimension is broadcast only when its row count is known (recorded when
the warehouse table was written) and at most ``max_rows``.  Otherwise the
join is left to the planner: Spark's size estimate and AQE's runtime
statistics still turn it into a broadcast when the data is small, and it
stays a shuffle join when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 1_000_000
CONF_KEY = "salesloom.broadcastMaxRows"   # session setting overriding the default


def broadcast_limit(spark: SparkSession | None = None) -> int:
    """Row bound for a dimension broadcast: the session's
    ``salesloom.broadcastMaxRows`` when set, else 1,000,000."""
    if spark is None:
        spark = SparkSession.getActiveSession()
    v = spark.conf.get(CONF_KEY, None) if spark is not None else None
    return int(v) if v not in (None, "") else BROADCAST_MAX_ROWS


def broadcastable(rows: int | None, max_rows: int | None = None) -> bool:
    limit = broadcast_limit() if max_rows is None else max_rows
    return rows is not None and rows <= limit


ROWS_PER_TASK = 1_000_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` rows, about a million each but not fewer than the cores.  Sizes in bytes do not tell
    how many rows a shuffled partition has in memory: sorted keys compress to a byte or two."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def join_dim(left: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
             rows: int | None = None, max_rows: int | None = None) -> DataFrame:
    """``left.join(dim, on, how)``; ``dim`` is broadcast iff ``rows`` is known
    and within the bound (``max_rows`` or the session setting)."""
    right = F.broadcast(dim) if broadcastable(rows, max_rows) else dim
    return left.join(right, on, how)


def left_lookup(left: DataFrame, dim: DataFrame, key: str, rows: int | None = None,
                max_rows: int | None = None) -> DataFrame:
    """``left.join(dim, key, "left")`` for a key that may be null in many rows of ``left``.

    Null keys match nothing, but a shuffle join would send all of them to one task.
    Beyond the broadcast bound they are spread by a second key, a hash of the row; rows
    with a key have 0 there, as all of ``dim``."""
    if broadcastable(rows, max_rows):
        return left.join(F.broadcast(dim), key, "left")
    plain = [c for c, t in left.dtypes if "map" not in t and "variant" not in t]
    zero = F.col(key) - F.col(key)         # 0, but not a constant that the optimiser would take out of the join
    spread = F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(zero.cast("bigint"))
    return (left.withColumn("_spread", spread)
            .join(dim.withColumn("_spread", zero.cast("bigint")), [key, "_spread"], "left").drop("_spread"))
