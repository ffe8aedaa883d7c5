"""The loader's admission by bytes, observed counters and the time dimension kept in stream state."""

import os

from pyspark.sql import functions as F

from salesloom.plans.catalog import QUERIES
from salesloom.streaming import (input_bytes, inserted_time_dim, stream_fact, stream_time_rows, streamed_fact,
                                 streamed_metrics, streamed_rejects, streamed_time_dim, write_masters)
from tests.conftest import SF_SMALL
from tests.test_stream import write_dims


def folders(spark, tmp_dir):
    dims, inp, out, ck = (f"{tmp_dir}/{n}" for n in ("dims", "in", "out", "ck"))
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    return dims, inp, out, ck


def put(inp, i, lines):
    path = f"{inp}/f{i}.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + i * 60,) * 2)           # arrival order


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batches_follow_bytes_per_trigger(spark, tmp_dir):
    dims, inp, out, ck = folders(spark, tmp_dir)
    for i in range(6):
        put(inp, i, [f"{i}{n},1,1,50,1/{1 + i}/2019,1:05 PM,{i}" for n in range(10, 40)])
    one = os.path.getsize(f"{inp}/f0.csv")
    assert input_bytes(spark, inp) == sum(os.path.getsize(f"{inp}/{f}") for f in os.listdir(inp))
    facts = []
    for files, size, batches in ((None, 2 * one, 3), (None, 1, 6), (None, None, 1), (4, None, 2)):
        o, c = f"{out}-{files}-{size}", f"{ck}-{files}-{size}"
        stream_fact(spark, inp, dims, o, c, max_files=files, max_bytes=size).awaitTermination()
        assert spark.read.parquet(f"{o}/ledger").select("batch_id").distinct().count() == batches
        facts.append(rows(streamed_fact(spark, o)))
    assert len(facts[0]) == 180 and all(f == facts[0] for f in facts)


def test_time_rows_are_inserted_once_and_survive_a_restart(spark, tmp_dir):
    dims, inp, out, ck = folders(spark, tmp_dir)
    tck = f"{tmp_dir}/time_ck"

    def drain():
        stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
        stream_time_rows(spark, out, tck).awaitTermination()

    # the first to arrive is not the earliest; two candidates in one batch; one line only dates
    put(inp, 0, ["7,1,1,50,1/9/2019,1:05 PM,1", "8,1,1,50,1/2/2019,1:05 PM,1", "x,1,1,50,2/2/2019,3:00 AM,2"])
    put(inp, 1, ["7,1,2,50,1/3/2019,1:05 PM,1", "9,1,1,50,1/4/2019,1:05 PM,3"])
    drain()
    put(inp, 2, ["7,1,4,50,1/1/2019,1:05 PM,1", "9,1,1,50,5/5/2019,6:00 AM,4", "bad"])
    drain()                                                  # state comes back from the checkpoint
    got = rows(inserted_time_dim(spark, out))
    assert got == rows(streamed_time_dim(spark, out))
    assert [(r[0], str(r[1])) for r in got] == [(1, "2019-01-09"), (2, "2019-02-02"), (3, "2019-01-04"), (4, "2019-05-05")]
    inserted = spark.read.parquet(f"{out}/time_rows")
    assert inserted.count() == 4                             # a stored timeID is never written again
    assert [r.n for r in inserted.groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()] == [3, 1]
    drain()                                                  # nothing new
    assert rows(inserted_time_dim(spark, out)) == got
    for f in ("1", ".1.crc"):                                # the second trigger ran, its commit was lost
        if os.path.exists(f"{tck}/commits/{f}"):
            os.remove(f"{tck}/commits/{f}")
    drain()
    assert rows(inserted_time_dim(spark, out)) == got
    fact = {r.orderID: r for r in streamed_fact(spark, out).collect()}
    assert (str(fact[7].orderDate), fact[7].quantityOrdered) == ("2019-01-09", 7)


def test_observed_counters_equal_counts(spark, tmp_dir):
    dims, inp, out, ck = folders(spark, tmp_dir)
    put(inp, 0, ["1,1,1,50,1/9/2019,1:05 PM,1", "bad", "2,1,1.0,50,1/9/2019,1:05 PM,1"])
    put(inp, 1, ["3,9,1,50,1/9/2019,1:05 PM,1", "4,1,1,99,1/9/2019,1:05 PM,1", "5,1,99999999,50,1/9/2019,1:05 PM,1",
                 "6,1,1,50,13/9/2019,1:05 PM,1"])
    stream_fact(spark, inp, dims, out, ck).awaitTermination()
    got = {r["counter"]: r["rows"] for r in streamed_metrics(spark, out).collect()}
    reasons = {r.reject_reason: r["count"] for r in streamed_rejects(spark, out).groupBy("reject_reason").count().collect()}
    assert {k: v for k, v in got.items() if v and k not in ("read", "loaded", "time_candidates")} == reasons
    assert (got["read"], got["loaded"], got["time_candidates"]) == (7, 1, 5) and sum(reasons.values()) == 6
    for f in ("1", ".1.crc"):                                # a replayed batch counts once
        if os.path.exists(f"{ck}/commits/{f}"):
            os.remove(f"{ck}/commits/{f}")
    stream_fact(spark, inp, dims, out, ck).awaitTermination()
    assert {r["counter"]: r["rows"] for r in streamed_metrics(spark, out).collect()} == got


def test_deliveries_bring_several_dates_per_key(spark):
    """The registered entries show first arrivals on keys that have several dates."""
    from salesloom.sources.tables import event_delivery_lines
    from salesloom.sources.transactions import parse_transactions
    dates = (parse_transactions(event_delivery_lines(spark, SF_SMALL)).groupBy("orderID", "productID", "customerID")
             .agg(F.countDistinct("orderDate").alias("n"), F.min("orderDate").alias("least")))
    fact = QUERIES["stream_first_arrivals"](spark, SF_SMALL)
    both = fact.join(dates, ["orderID", "productID", "customerID"])
    assert both.where("n > 1").count() > 0 and both.where("orderDate > least").count() > 0
