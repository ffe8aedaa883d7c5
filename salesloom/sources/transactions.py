"""Transaction text: parse, quarantine, and time-dimension candidates.

The file layout (see ``schemas.TRANSACTION_FIELDS``) is comma separated
*without* quote handling.  Rules, chosen to match a Java ``split(",")`` /
``parseInt`` / strict date parser:

* trailing empty fields are dropped before counting (``1,2,3,4,d,t,7,,`` has
  seven fields), then exactly seven fields are required -> ``bad_arity``;
* integers must match ``^[+-]?[0-9]+$`` (no spaces, no ``5.0``) and fit the
  column type -> ``bad_integer``;
* ``date + ' ' + time`` must parse strictly as ``M/d/yyyy h:mm a``
  (no rolling of 02/30 or month 13, no trailing text) -> ``bad_timestamp``.

Works unchanged on a batch ``DataFrame`` and on a streaming one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.calendar import time_parts
from salesloom.schemas import TRANSACTION_FIELDS, TRANSACTION_TS_FORMAT

DEFAULT_HEADER = ",".join(TRANSACTION_FIELDS)
#: Why the parser rejects a line, in the order in which the rules are tried.
PARSE_REASONS = ("bad_arity", "bad_integer", "bad_timestamp")
_INT_RE = r"^[+-]?[0-9]+$"


def read_transaction_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch text scan with an arrival key (file path, line position).

    ``monotonically_increasing_id`` follows the scan order inside each file
    split, and splits of one file are numbered in file order.
    """
    return (spark.read.text(path)
            .withColumn("arrival", F.struct(F.col("_metadata.file_path").alias("file"),
                                            F.monotonically_increasing_id().alias("pos"))))


def _int(field: Column, type_: str) -> Column:
    return F.when(field.rlike(_INT_RE), field.try_cast(type_))


def _with_fields(lines: DataFrame, header: str | None) -> DataFrame:
    """``lines`` but the header, with their fields in ``_f``.

    The fields come from a generator (of one row, or none for the header): a filter on
    what is parsed from them stays above it.  Pushed below a projection, it would render
    and split the line anew for every field that it names."""
    bare = F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", r"\r$", "")).otherwise(F.col("value"))
    df = lines.withColumn("_line", bare)
    fields = F.array(F.split(F.regexp_replace("_line", ",+$", ""), ",", -1))
    if header is not None:
        fields = F.when(F.col("_line") != F.lit(header), fields)
    return df.select("*", F.explode(fields).alias("_f")).drop("_line")


#: Field number and type of the whole numbers of a line.
_WHOLE = {"orderID": (0, "bigint"), "productID": (1, "bigint"), "quantityOrdered": (2, "int"),
          "customerID": (3, "bigint"), "timeID": (6, "bigint")}


def _with_values(df: DataFrame, whole: Sequence[str]) -> DataFrame:
    """``df`` with the ``whole`` numbers and the ``orderTS`` of ``_f`` in the struct ``_v``: null
    unless there are seven fields.

    A generator again, so that each value is parsed once, not for every column and rule that
    names it.  Texts without the signs that every date and time has never reach the timestamp parser,
    which throws an exception for what it does not take."""
    f = F.col("_f")
    text = F.concat_ws(" ", f.getItem(4), f.getItem(5))
    ts = F.when(text.contains("/") & text.contains(":"), F.try_to_timestamp(text, F.lit(TRANSACTION_TS_FORMAT)))
    ints = [_int(f.getItem(i), t).alias(k) for k, (i, t) in _WHOLE.items() if k in whole]
    values = F.when(F.size("_f") == 7, F.struct(*ints, ts.alias("orderTS")))
    return df.select("*", F.explode(F.array(values)).alias("_v"))


def parse_transactions(lines: DataFrame, header: str | None = DEFAULT_HEADER) -> DataFrame:
    """Typed transactions plus ``raw`` and ``reject_reason`` (NULL = accepted).

    ``time_ok`` marks rows that may feed the time dimension (seven fields, a
    valid timeID and timestamp), whatever the other fields hold.

    ``lines`` has the text in ``value``; an ``arrival`` column, when present,
    is carried through (it orders rows for first-arrival rules).
    """
    df = _with_values(_with_fields(lines, header), list(_WHOLE))
    ints = {k: F.col(f"_v.{k}") for k in _WHOLE}
    arity_ok = F.size("_f") == 7
    ts = F.col("_v.orderTS")
    ints_ok = None
    for c in ints.values():
        ints_ok = c.isNotNull() if ints_ok is None else (ints_ok & c.isNotNull())
    reason = (F.when(~arity_ok, F.lit(PARSE_REASONS[0]))
              .when(~ints_ok, F.lit(PARSE_REASONS[1]))
              .when(ts.isNull(), F.lit(PARSE_REASONS[2])))
    keep = [c for c in ("arrival",) if c in lines.columns]
    out = df.select(
        *[v.alias(k) for k, v in ints.items()],
        ts.alias("orderTS"),
        F.col("value").alias("raw"),
        *keep,
        (arity_ok & ints["timeID"].isNotNull() & ts.isNotNull()).alias("time_ok"),
        reason.alias("reject_reason"),
    )
    return out.select("orderID", "productID", "quantityOrdered", "customerID",
                      F.to_date("orderTS").alias("orderDate"),
                      F.date_format("orderTS", "HH:mm:ss").alias("orderTime"),
                      "timeID", "orderTS", "raw", *keep, "time_ok", "reject_reason")


def txn_rejects(parsed: DataFrame) -> DataFrame:
    """The quarantine side of :func:`parse_transactions`."""
    return parsed.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")


def time_candidates(lines: DataFrame, header: str | None = DEFAULT_HEADER) -> DataFrame:
    """Rows that may define a time-dimension entry.

    Looser than the fact side: only the arity, the timeID and the timestamp
    must be valid; a bad orderID or productID does not matter.  Output:
    ``timeID, orderTS, arrival``.
    """
    df = _with_values(_with_fields(lines, header), ["timeID"])
    tid, ts = F.col("_v.timeID"), F.col("_v.orderTS")
    arrival = F.col("arrival") if "arrival" in lines.columns else F.monotonically_increasing_id()
    return (df.where(tid.isNotNull() & ts.isNotNull())
            .select(tid.alias("timeID"), ts.alias("orderTS"), arrival.alias("arrival")))


def time_rows(candidates: DataFrame) -> DataFrame:
    """One time-dimension row per timeID: the first parseable arrival wins."""
    first = (candidates.groupBy("timeID")
             .agg(F.min_by("orderTS", "arrival").alias("orderTS")))
    return first.select("timeID", *time_parts("orderTS"))
