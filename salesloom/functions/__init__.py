"""Scalar Column helpers; all are built-in Spark expressions (no UDFs)."""

from salesloom.functions.calendar import (day_type, field_position, half_year,
                                          season, time_parts)
from salesloom.functions.decimals import (cents_avg_round2, mysql_avg, mysql_div,
                                          pct_change_label, prev_label, to_money)

__all__ = ["day_type", "field_position", "half_year", "season", "time_parts",
           "cents_avg_round2", "mysql_avg", "mysql_div", "pct_change_label",
           "prev_label", "to_money"]
