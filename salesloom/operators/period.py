"""Prior-period comparison.

The source SQL left-joins an aggregate to itself on
``same partition AND cur.period = prev.period + 1``.  With unique period
values per partition that equals ``lag`` over the partition, kept only when
the lagged period is exactly one step back.  The window form shuffles the
(already aggregated) rows once; the self-join form is kept for testing that
both agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, partition_cols: Sequence[str], period_col: str,
                  value_col: str, out_col: str = "PreviousRevenue", step: int = 1) -> DataFrame:
    w = Window.partitionBy(*partition_cols).orderBy(F.col(period_col))
    prev_period = F.lag(period_col).over(w)
    prev_value = F.lag(value_col).over(w)
    return df.withColumn(out_col, F.when(prev_period == F.col(period_col) - step, prev_value))


def with_previous_self_join(df: DataFrame, partition_cols: Sequence[str], period_col: str,
                            value_col: str, out_col: str = "PreviousRevenue",
                            step: int = 1) -> DataFrame:
    prev = df.select(*partition_cols, (F.col(period_col) + step).alias(period_col),
                     F.col(value_col).alias(out_col))
    return df.join(prev, [*partition_cols, period_col], "left")
