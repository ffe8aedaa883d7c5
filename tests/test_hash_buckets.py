"""Appends and compactions rewrite only the hash buckets of their keys, and read no others."""

import os

import pytest

from salesloom.plans import star as S
from salesloom.sources.transactions import parse_transactions
from salesloom.streaming import compact_ledger, stream_fact, streamed_fact, write_masters
from salesloom.streaming import fact_stream as FS
from tests.conftest import SF_SMALL
from tests.test_stream import write_dims


def _lines(spark, *lines):
    return parse_transactions(spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, arrival int"))


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wh"))
    S.load_warehouse(spark, SF_SMALL, path)
    return path


def _parts(spark, path):
    return S._fact_parts(spark, S.table_locations(spark, path)["fact"])


def _spoil(parts, untouched):
    """Make the rows of some parts unreadable; footers (schema, row counts) stay."""
    kept = []
    for p in untouched:
        folder = f"{parts[p].location}/fact/{S._part_folder(p)}"
        for name in os.listdir(folder):
            file = f"{folder}/{name}"
            if name.endswith(".parquet"):
                with open(file, "rb") as f:
                    data = f.read()
                kept.append((file, data))
                footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
                with open(file, "wb") as f:
                    f.write(data[:4] + b"\xff" * (footer - 4) + data[footer:])
            elif name.endswith(".crc"):
                os.remove(file)
    return kept


def test_one_late_row_rewrites_one_bucket_and_reads_no_other(spark, warehouse):
    before = _parts(spark, warehouse)
    whole = S.read_star(spark, warehouse).fact
    rows = whole.count()
    late = whole.orderBy("orderID", "productID", "customerID").first()
    part = (late[S.PART_YEAR], late[S.PART_BUCKET])
    line = f"{late.orderID},{late.productID},3,{late.customerID},1/5/1998,10:30 AM,199801051030"
    hidden = _spoil(before, [p for p in before if p[1] != part[1]])
    with pytest.raises(Exception):
        whole.agg({c: "max" for c in whole.columns[:9]}).collect()
    try:
        S.append_transactions(spark, warehouse, _lines(spark, line))
    finally:
        for file, data in hidden:
            with open(file, "wb") as f:
                f.write(data)
    after = _parts(spark, warehouse)
    changed = {p for p in after if after[p].location != before[p].location}
    assert set(after) == set(before) and changed == {part}
    assert after[part].version == before[part].version + 1
    star = S.read_star(spark, warehouse)
    assert star.fact.count() == rows
    same = {k: late[k] for k in ("orderID", "productID", "customerID")}
    now = star.fact.where(" AND ".join(f"{k} = {v}" for k, v in same.items())).first()
    assert now.quantityOrdered == late.quantityOrdered + 3 and now.timeID == late.timeID
    assert all(r.part_bucket == r.b for r in star.fact.select("part_bucket", S.key_bucket(S.HASH_BUCKETS).alias("b"))
               .distinct().collect())


def test_appends_equal_one_load(spark, warehouse):
    """Rows of new and stored keys, in several years, null results and rejects: as one collapse of all."""
    def by_key(star):
        return {(r.orderID, r.productID, r.customerID): r for r in star.fact_rows().collect()}

    old = by_key(S.read_star(spark, warehouse))
    keys = sorted(old)[:: max(1, len(old) // 40)]
    lines = [f"{o},{p},1,{c},1/5/{1992 + i % 9},10:30 AM,{1992 + i % 9}01051030" for i, (o, p, c) in enumerate(keys)]
    lines += [f"{910000 + i},{1 + i % 20},2,1,3/1/{1990 + i % 4},9:15 AM,{1990 + i % 4}03010915" for i in range(40)]
    lines += ["bad", "1,999999999,1,1,1/5/1998,10:30 AM,199801051030"]
    star = S.append_transactions(spark, warehouse, _lines(spark, *lines))
    now = by_key(star)
    assert set(old) <= set(now) and len(now) == star.fact.count()
    for k, r in old.items():
        extra = 1 if k in set(keys) else 0
        assert (now[k].quantityOrdered, now[k].timeID) == (r.quantityOrdered + extra, r.timeID)
    added = {k: r for k, r in now.items() if k not in old}
    assert len(added) == 40 and {r.quantityOrdered for r in added.values()} == {2}
    years = {r.part_year for r in star.fact.where("orderID >= 910000").select("part_year").collect()}
    assert years == {1990, 1991, 1992, 1993}
    again = S.append_transactions(spark, warehouse, _lines(spark).limit(0))
    assert again.fact.count() == len(now)


def test_compaction_rewrites_only_touched_buckets(spark, tmp_dir):
    dims, inp, out, ck = (f"{tmp_dir}/{n}" for n in ("dims", "in", "out", "ck"))
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)

    def run(i, lines):
        with open(f"{inp}/f{i}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(f"{inp}/f{i}.csv", (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
        stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()

    run(0, [f"{o},1,1,50,1/2/2019,1:05 PM,1" for o in range(60)])
    compact_ledger(spark, out, upto=0)
    first = FS._compaction(spark, out)
    assert set(first["parts"]) == set(range(first["buckets"]))
    run(1, ["7,1,2,50,2/2/2019,1:05 PM,3", "bad"])
    want = sorted(tuple(r) for r in streamed_fact(spark, out).collect())
    bucket = spark.createDataFrame([(7, 1, 50)], "orderID long, productID long, customerID long").select(
        S.key_bucket(first["buckets"])).first()[0]
    hidden = []
    for b, folder in first["parts"].items():
        if b != bucket:
            hidden.append((f"{folder}/facts/part_bucket={b}", f"{folder}/hidden-{b}"))
            os.rename(*hidden[-1])
    try:
        compact_ledger(spark, out, upto=1)          # no other bucket is there to be read
    finally:
        for at, kept in hidden:
            os.rename(kept, at)
    second = FS._compaction(spark, out)
    assert {b for b in second["parts"] if second["parts"][b] != first["parts"][b]} == {bucket}
    assert sorted(tuple(r) for r in streamed_fact(spark, out).collect()) == want
    assert len(second["rejects"]) == 2
