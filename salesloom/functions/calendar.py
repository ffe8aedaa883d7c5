"""Calendar buckets used by the analytic queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the queries.
# Weekend day numbers in DAYOFWEEK numbering (1 = Sunday): 6 and 7, i.e.
# Friday and Saturday, labelled 'Weekend'; every other day is 'Weekday'.
WEEKEND_DAYS = (6, 7)
# Seasons by calendar month; the season keeps the calendar year.
SEASONS = (("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)),
           ("Fall", (9, 10, 11)), ("Winter", (12, 1, 2)))
SEASON_ORDER = ("Spring", "Summer", "Fall", "Winter")
# Half years by quarter.
HALVES = (("H1", (1, 2)), ("H2", (3, 4)))
HALF_ORDER = ("H1", "H2", "Yearly")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_type(date, weekend: Sequence[int] = WEEKEND_DAYS) -> Column:
    """'Weekend' when ``dayofweek(date)`` (1 = Sunday) is in ``weekend``."""
    return (F.when(F.dayofweek(_col(date)).isin(list(weekend)), F.lit("Weekend"))
            .otherwise(F.lit("Weekday")))


def _bucket(value, table) -> Column:
    v = _col(value)
    out = None
    for label, members in table:
        cond = v.isin(list(members))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out  # no ELSE: values outside every bucket give NULL


def season(month) -> Column:
    return _bucket(month, SEASONS)


def half_year(quarter) -> Column:
    return _bucket(quarter, HALVES)


def field_position(value, order: Sequence[str]) -> Column:
    """MySQL ``FIELD(value, order...)``: 1-based position, 0 when absent or NULL."""
    arr = F.array(*[F.lit(x) for x in order])
    return F.coalesce(F.array_position(arr, _col(value)), F.lit(0)).cast("int")


def time_parts(ts) -> list[Column]:
    """Time-dimension columns from one timestamp: date, time text, parts."""
    t = _col(ts)
    d = F.to_date(t)
    return [d.alias("orderDate"),
            F.date_format(t, "HH:mm:ss").alias("orderTime"),
            F.dayofmonth(d).alias("Day"),
            F.month(d).alias("Month"),
            F.quarter(d).alias("Quarter"),
            F.year(d).alias("Year")]
