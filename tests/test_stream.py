import os
import random

from pyspark.sql import functions as F

from salesloom.operators.enrich import accepted_facts, enrich_transactions
from salesloom.operators.fact import collapse_fact
from salesloom.sources.transactions import DEFAULT_HEADER, parse_transactions
from salesloom.streaming import (live_fact_totals, stream_fact, streamed_fact, streamed_rejects, streamed_time_dim,
                                 write_masters)


def write_dims(spark, path):
    spark.createDataFrame(
        [(1, "A", 10.0, 100, "Sup", 5, "Store"), (2, "B", 2.5, 100, "Sup", 5, "Store")],
        "productID long, productName string, productPrice double, supplierID long, "
        "supplierName string, storeID long, storeName string"
    ).withColumn("productPrice", F.col("productPrice").cast("decimal(10,2)")).write.parquet(f"{path}/staging")
    spark.createDataFrame([(100, "Sup")], "supplierID long, supplierName string").write.parquet(f"{path}/supplier")
    spark.createDataFrame([(5, "Store")], "storeID long, storeName string").write.parquet(f"{path}/store")
    spark.createDataFrame([(50, "Ann", "F"), (51, "Bo", "M")],
                          "customerID long, customerName string, gender string").write.parquet(f"{path}/customer")


def test_stream_equals_batch_and_restart_does_not_double(spark, tmp_dir):
    rnd = random.Random(11)
    lines = [f"{o},{1 + o % 2},{1 + o % 3},{50 + o % 2},1/{1 + o % 9}/2019,{1 + o % 12}:05 PM,{o % 9}"
             for o in range(40)]
    lines += ["1,1,1,50,1/1/2019,1:05 PM,0"] * 3          # repeated key: additive
    lines += ["bad line", "9,3,1,50,1/1/2019,1:05 PM,0"]   # parse reject, unknown product
    rnd.shuffle(lines)
    dims, inp = f"{tmp_dir}/dims", f"{tmp_dir}/in"
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    for i in range(4):
        with open(f"{inp}/part-{i}.csv", "w") as f:
            f.write(DEFAULT_HEADER + "\n" + "\n".join(lines[i::4]) + "\n")
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    streamed = sorted(tuple(r) for r in streamed_fact(spark, out).drop("orderDate", "timeID").collect())

    batch_lines = spark.createDataFrame([(x,) for x in lines], "value string")
    e = enrich_transactions(parse_transactions(batch_lines), d["staging"], d["supplier"], d["store"], d["customer"])
    batch = sorted(tuple(r) for r in collapse_fact(accepted_facts(e)).drop("orderDate", "timeID").collect())
    assert streamed == batch
    assert spark.read.parquet(f"{out}/ledger").select("batch_id").distinct().count() == 4
    rejects = sorted(r.reject_reason for r in streamed_rejects(spark, out).collect())
    assert rejects == ["bad_arity", "product_not_found"]
    assert streamed_time_dim(spark, out).count() == 9

    # restart on the same checkpoint: nothing new, nothing doubled
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    again = sorted(tuple(r) for r in streamed_fact(spark, out).drop("orderDate", "timeID").collect())
    assert again == streamed

    # live totals in update mode agree with the ledger's fact
    live = (live_fact_totals(spark, inp, dims, max_files=2).writeStream.outputMode("update")
            .format("memory").queryName("live_totals")
            .option("checkpointLocation", f"{tmp_dir}/ck_live").trigger(availableNow=True).start())
    live.awaitTermination()
    latest = spark.sql("select * from live_totals")
    from pyspark.sql import Window
    w = Window.partitionBy("orderID", "productID", "customerID").orderBy(F.desc("quantityOrdered"))
    final = latest.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = sorted(tuple(r) for r in final.drop("orderDate", "timeID").collect())
    assert got == streamed


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    """A crash after a batch wrote its ledger but before the commit: Spark
    re-runs that batch on restart and its folder is overwritten, not added."""
    dims, inp, out, ck = (f"{tmp_dir}/{n}" for n in ("dims", "in", "out", "ck"))
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    for i in range(3):
        with open(f"{inp}/f{i}.csv", "w") as f:
            f.write(DEFAULT_HEADER + "\n" + f"7,1,{i + 1},50,1/{i + 2}/2019,1:05 PM,{i}\n")
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    before = sorted(tuple(r) for r in streamed_fact(spark, out).collect())
    assert before[0][7] == 6                                   # 1 + 2 + 3, additive
    for f in (f"{ck}/commits/2", f"{ck}/commits/.2.crc"):      # batch 2 ran, commit lost
        if os.path.exists(f):
            os.remove(f)
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    assert sorted(tuple(r) for r in streamed_fact(spark, out).collect()) == before


def test_live_totals_with_watermark(spark, tmp_dir):
    dims, inp = f"{tmp_dir}/dims", f"{tmp_dir}/in"
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    with open(f"{inp}/a.csv", "w") as f:
        f.write("1,1,2,50,1/5/2019,1:00 PM,1\n1,1,3,50,1/5/2019,2:00 PM,1\n")
    q = (live_fact_totals(spark, inp, dims, watermark="1 day").writeStream.outputMode("update")
         .format("memory").queryName("live_wm").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("select quantityOrdered, window from live_wm").collect()
    assert [r.quantityOrdered for r in rows] == [5] and rows[0].window is not None


def test_stream_from_a_lines_dataframe(spark, tmp_dir):
    dims, inp = f"{tmp_dir}/dims", f"{tmp_dir}/in"
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    with open(f"{inp}/a.csv", "w") as f:
        f.write("1,1,2,50,1/5/2019,1:00 PM,1\n1,1,3,50,1/5/2019,2:00 PM,1\n2,2,1,51,1/6/2019,1:00 PM,2\n")
    lines = spark.readStream.format("text").load(inp)
    stream_fact(spark, lines, dims, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {r.orderID: (r.quantityOrdered, float(r.totalSale))
           for r in streamed_fact(spark, f"{tmp_dir}/out").collect()}
    assert got == {1: (5, 50.0), 2: (1, 2.5)}


def test_compaction_keeps_fact_time_and_rejects(spark, tmp_dir):
    from salesloom.streaming import compact_ledger
    dims, inp, out, ck = (f"{tmp_dir}/{n}" for n in ("dims", "in", "out", "ck"))
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    batches = [["7,1,1,50,1/2/2019,1:05 PM,1", "8,2,2,51,1/3/2019,1:05 PM,2", "bad"],
               ["7,1,2,50,2/2/2019,1:05 PM,3", "9,1,1,50,1/2/2019,9:00 AM,1"],
               ["7,1,4,50,3/2/2019,1:05 PM,4", "x,1,1,50,3/3/2019,1:05 PM,5"],
               ["8,2,1,51,4/3/2019,1:05 PM,6"]]

    def add(i):
        path = f"{inp}/f{i}.csv"
        with open(path, "w") as f:
            f.write("\n".join(batches[i]) + "\n")
        os.utime(path, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))  # arrival order

    def state():
        fact = sorted(tuple(r) for r in streamed_fact(spark, out).collect())
        time = sorted(tuple(r) for r in streamed_time_dim(spark, out).collect())
        rej = sorted(r.reject_reason for r in streamed_rejects(spark, out).collect())
        return fact, time, rej

    for i in range(2):
        add(i)
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    before = state()
    compact_ledger(spark, out, upto=1)
    assert state() == before
    for i in range(2, 4):
        add(i)
    stream_fact(spark, inp, dims, out, ck, max_files=1).awaitTermination()
    after = state()
    compact_ledger(spark, out, upto=2)
    assert state() == after
    fact = {r.orderID: r for r in streamed_fact(spark, out).collect()}
    assert fact[7].quantityOrdered == 7 and fact[7].timeID == 1     # first arrival kept
    assert after[2] == ["bad_arity", "bad_integer"]
    assert [t[0] for t in after[1]] == [1, 2, 3, 4, 5, 6]


def test_live_totals_from_a_lines_dataframe(spark, tmp_dir):
    dims, inp = f"{tmp_dir}/dims", f"{tmp_dir}/in"
    write_dims(spark, dims)
    d = {n: spark.read.parquet(f"{dims}/{n}") for n in ("staging", "supplier", "store", "customer")}
    write_masters(d["staging"], d["supplier"], d["store"], d["customer"], dims)
    os.makedirs(inp)
    with open(f"{inp}/a.csv", "w") as f:
        f.write("1,1,2,50,1/5/2019,1:00 PM,1\n1,1,3,50,1/5/2019,2:00 PM,1\n")
    q = (live_fact_totals(spark, spark.readStream.format("text").load(inp), dims)
         .writeStream.outputMode("update").format("memory").queryName("live_df")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.quantityOrdered for r in spark.sql("select * from live_df").collect()] == [5]
