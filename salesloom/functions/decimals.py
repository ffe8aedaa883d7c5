"""Exact money arithmetic.

Amounts are ``decimal(10,2)`` per row and exact decimal sums after that.
Divisions follow the semantics of the SQL the queries were written for:
a quotient of two exact decimals carries the dividend's scale plus 4 and is
rounded half-up there; ``ROUND(x, 2)`` is then applied to that value, so
a two-decimal average is ``round(round(sum / n, 6), 2)``.  A growth rate is
rounded once, half away from zero, in whole hundredths of a percent:
``sign(d) * ((abs(d) * 20000 + b) // (2 * b))`` of amounts in cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.schemas import MONEY

DIV_SCALE_INCREMENT = 4
WIDE = "decimal(18,2)"   # operand type for quotients: keeps 20 quotient digits


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    """Cast to DECIMAL(10,2); an out-of-range value raises under ANSI."""
    return _col(c).cast(MONEY)


def mysql_div(a, b, scale: int = 2) -> Column:
    """``a / b`` of two scale-2 decimals, rounded half-up at scale + 4.

    Division by zero gives NULL.
    """
    q = F.try_divide(_col(a).cast(WIDE), _col(b).cast(WIDE))
    return F.round(q, scale + DIV_SCALE_INCREMENT)


def mysql_avg(total, n, scale: int = 2) -> Column:
    """``AVG`` of scale-2 decimals from its sum and row count (scale + 4)."""
    q = F.try_divide(_col(total).cast(WIDE), _col(n).cast("decimal(18,0)"))
    return F.round(q, scale + DIV_SCALE_INCREMENT)


def cents_avg_round2(total, n) -> Column:
    """``ROUND(AVG(x), 2)`` from the sum and the count, as ``decimal(18,2)``."""
    return F.round(mysql_avg(total, n), 2).cast(WIDE)


def pct_change_label(cur, prev) -> Column:
    """``CONCAT(ROUND(((cur - prev) / prev) * 100, 2), '%')``, '-' without prev.

    ``prev = 0`` gives NULL, as a division by zero does in the source SQL.
    """
    c, p = _col(cur), _col(prev)
    d, b = ((x * 100).cast("decimal(22,0)") for x in (c.cast(WIDE) - p.cast(WIDE), p.cast(WIDE)))
    twice = F.abs(b) * 2
    top = F.abs(d) * 20000 + F.abs(b)
    whole = F.try_divide(top - F.try_mod(top, twice), twice)     # divides without rest
    sign = F.when((d < 0) != (b < 0), F.lit(-1)).otherwise(F.lit(1))
    pct = (whole.cast("decimal(30,0)") * sign * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(32,2)")
    return (F.when(p.isNull(), F.lit("-"))
            .otherwise(F.concat(pct.cast("string"), F.lit("%"))))


def prev_label(prev) -> Column:
    """The previous amount as text, or '-' when there is none."""
    p = _col(prev)
    return F.when(p.isNull(), F.lit("-")).otherwise(p.cast(WIDE).cast("string"))
