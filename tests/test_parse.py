import datetime as dt

from salesloom.operators.dims import dim_time, merge_time_dim
from salesloom.sources.transactions import (DEFAULT_HEADER, parse_transactions, time_candidates,
                                            txn_rejects)


def lines(spark, texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, arrival long")


def parsed_by_raw(spark, texts):
    return {r.raw: r for r in parse_transactions(lines(spark, texts)).collect()}


def test_arity_like_java_split(spark):
    texts = ["1,2,3,4,1/5/2019,3:07 PM",            # 6 fields
             "1,2,3,4,1/5/2019,3:07 PM,7",          # 7
             "1,2,3,4,1/5/2019,3:07 PM,7,,",        # trailing empties dropped -> 7
             "1,2,3,4,1/5/2019,3:07 PM,",           # 6 + trailing comma -> 6
             "1,2,3,4,1/5/2019,3:07 PM,7,8",        # 8
             ""]
    got = parsed_by_raw(spark, texts)
    assert got[texts[0]].reject_reason == "bad_arity"
    assert got[texts[1]].reject_reason is None
    assert got[texts[2]].reject_reason is None
    assert got[texts[3]].reject_reason == "bad_arity"
    assert got[texts[4]].reject_reason == "bad_arity"
    assert got[""].reject_reason == "bad_arity"


def test_header_dropped(spark):
    got = parse_transactions(lines(spark, [DEFAULT_HEADER, "1,2,3,4,1/5/2019,3:07 PM,7"]))
    assert got.count() == 1


def test_integers_strict(spark):
    base = "1,2,{q},4,1/5/2019,3:07 PM,7"
    texts = [base.format(q=q) for q in (" 5", "+5", "5.0", "99999999999", "", "-3")]
    got = parsed_by_raw(spark, texts)
    assert got[texts[0]].reject_reason == "bad_integer"
    assert got[texts[1]].reject_reason is None and got[texts[1]].quantityOrdered == 5
    assert got[texts[2]].reject_reason == "bad_integer"
    assert got[texts[3]].reject_reason == "bad_integer"      # over int range
    assert got[texts[4]].reject_reason == "bad_integer"
    assert got[texts[5]].quantityOrdered == -3


def test_timestamps_strict(spark):
    base = "1,2,3,4,{d},{t},7"
    cases = {("1/5/2019", "12:00 AM"): dt.datetime(2019, 1, 5, 0, 0),
             ("01/05/2019", "12:00 PM"): dt.datetime(2019, 1, 5, 12, 0),
             ("1/5/2019", "3:07 PM"): dt.datetime(2019, 1, 5, 15, 7),
             ("02/30/2019", "1:00 AM"): None,
             ("13/1/2019", "1:00 AM"): None,
             ("1/5/2019", "3:07 PM junk"): None}
    texts = {k: base.format(d=k[0], t=k[1]) for k in cases}
    got = parsed_by_raw(spark, list(texts.values()))
    for k, want in cases.items():
        r = got[texts[k]]
        if want is None:
            assert r.reject_reason == "bad_timestamp", k
        else:
            assert r.reject_reason is None and r.orderTS == want, k
    r = got[texts[("01/05/2019", "12:00 PM")]]
    assert r.orderDate == dt.date(2019, 1, 5) and r.orderTime == "12:00:00"
    assert txn_rejects(parse_transactions(lines(spark, list(texts.values())))).count() == 3


def test_time_dimension_rules(spark):
    texts = ["1,2,3,4,1/5/2019,3:07 PM,7",        # timeID 7 first
             "2,2,3,4,1/6/2019,3:07 PM,7",        # same timeID again: ignored
             "x,2,3,4,2/1/2019,9:00 AM,8",        # bad orderID, good timeID: still a candidate
             "3,2,3,4,02/30/2019,9:00 AM,9",      # first row of 9 has a bad date
             "4,2,3,4,3/1/2019,9:00 AM,9"]        # second row of 9 is good: used
    cand = time_candidates(lines(spark, texts))
    dims = {r.timeID: r for r in dim_time(cand).collect()}
    assert sorted(dims) == [7, 8, 9]
    assert dims[7].orderDate == dt.date(2019, 1, 5) and dims[7].Quarter == 1
    assert dims[8].Month == 2 and dims[9].orderDate == dt.date(2019, 3, 1)
    assert dims[7].orderTime == "15:07:00" and dims[7].Day == 5 and dims[7].Year == 2019
    existing = spark.createDataFrame(
        [(7, dt.date(2018, 12, 31), "00:00:00", 31, 12, 4, 2018)],
        "timeID long, orderDate date, orderTime string, Day int, Month int, Quarter int, Year int")
    merged = {r.timeID: r for r in merge_time_dim(existing, dim_time(cand)).collect()}
    assert merged[7].Year == 2018 and len(merged) == 3


def test_a_filter_on_parsed_columns_splits_a_line_once(spark):
    rows = lines(spark, ["1,2,3,4,1/5/2019,3:07 PM,7", DEFAULT_HEADER, "1,2,x,4,1/5/2019,3:07 PM,7", None])
    for df, found in ((txn_rejects(parse_transactions(rows)), 1), (time_candidates(rows), 2)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
        assert df.count() == found
    assert parse_transactions(rows, header=None).count() == 4


def test_each_value_is_parsed_once_whatever_names_it(spark):
    got = parse_transactions(lines(spark, ["1,2,3,4,1/5/2019,3:07 PM,7"]))
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("gettimestamp(") == 1 and plan.count("rlike") == 5


def test_texts_without_the_signs_of_a_date_and_time(spark):
    texts = ["1,2,3,4,2019-01-05,3:07 PM,7",        # no slash
             "1,2,3,4,1/5/2019,3.07 PM,7",          # no colon
             "1,2,3,4,,,7",
             "1,2,3,4,1/5/2019 3:07,PM,7"]          # the two fields are joined by a space
    got = parsed_by_raw(spark, texts)
    assert [got[t].reject_reason for t in texts] == ["bad_timestamp"] * 3 + [None]
    assert [got[t].time_ok for t in texts] == [False] * 3 + [True]
    assert [r.timeID for r in time_candidates(lines(spark, texts)).collect()] == [7]


def test_only_a_carriage_return_at_the_end_goes(spark):
    got = parsed_by_raw(spark, ["1,2,3,4,1/5/2019,3:07 PM,7\r", "1,2,3,4,1/5/2019\r,3:07 PM,7"])
    assert sorted(str(r.reject_reason) for r in got.values()) == ["None", "bad_timestamp"]
