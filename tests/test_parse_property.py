"""Property test: the Spark parser against a plain-Python model of the rules."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesloom.sources.transactions import parse_transactions

INTS = ["5", "+5", "-5", " 5", "5 ", "5.0", "", "99999999999", "2147483647", "x", "007"]
DATES = ["1/5/2019", "01/05/2019", "02/30/2019", "13/1/2019", "12/31/2019", "2/29/2020",
         "2/29/2019", "1/5/19x"]
TIMES = ["3:07 PM", "12:00 AM", "12:00 PM", "11:59 PM", "3:07 PM junk", "13:00 PM", "0:30 AM"]
INT_RE = re.compile(r"^[+-]?[0-9]+$")


def java_split(line):
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts else [""]


def model_int(s, bits):
    if not INT_RE.match(s):
        return None
    v = int(s)
    return v if -(2 ** (bits - 1)) <= v < 2 ** (bits - 1) else None


def model_ts(d, t):
    m = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{2}) (AM|PM)", f"{d} {t}")
    if not m:
        return None
    mo, da, y, h, mi, ap = m.groups()
    if not 1 <= int(h) <= 12:
        return None
    hour = int(h) % 12 + (12 if ap == "PM" else 0)
    try:
        return dt.datetime(int(y), int(mo), int(da), hour, int(mi))
    except ValueError:
        return None


def model(line):
    f = java_split(line)
    if len(f) != 7:
        return "bad_arity", None
    ints = [model_int(f[0], 64), model_int(f[1], 64), model_int(f[2], 32), model_int(f[3], 64),
            model_int(f[6], 64)]
    if any(v is None for v in ints):
        return "bad_integer", None
    ts = model_ts(f[4], f[5])
    if ts is None:
        return "bad_timestamp", None
    return None, (ints[0], ints[2], ts)


field = st.sampled_from(INTS)
line = st.builds(
    lambda a, b, c, d, e, f, g, tail: ",".join([a, b, c, d, e, f, g]) + tail,
    field, field, field, field, st.sampled_from(DATES), st.sampled_from(TIMES), field,
    st.sampled_from(["", ",", ",,", ",9", ",,9"]))


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(line, st.sampled_from(["", ",,,", "a,b"])), min_size=1, max_size=40))
def test_parser_matches_model(spark, lines):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, arrival long")
    got = {r.arrival: r for r in parse_transactions(df).collect()}
    for i, x in enumerate(lines):
        reason, vals = model(x)
        r = got[i]
        assert r.reject_reason == reason, (x, r.reject_reason, reason)
        if vals is not None:
            assert (r.orderID, r.quantityOrdered, r.orderTS) == vals, x
