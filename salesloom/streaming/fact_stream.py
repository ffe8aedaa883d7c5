"""Transaction text stream -> enriched ledger -> additive fact.

Design (no MERGE-capable table format is assumed):

* the source is a text file stream, admitted by files or by bytes per trigger;
* every micro-batch is parsed, enriched against the product master and
  customer keys (re-read each batch, so a reloaded master is seen; a master
  above the broadcast bound is first cut down to the batch's keys by a
  size-checked broadcast semi join) and written, in one
  write, to ``ledger/batch_id=N``: accepted rows, rejects with their
  reason and raw text, and the time-dimension candidates all live there.
  The folder is written with overwrite, so a batch that is replayed after
  a failure replaces its own output: with the checkpoint this makes the
  sink exactly-once;
* the fact is :func:`collapse_fact` over the ledger.  Sums commute, so late
  or out-of-order batches need no watermark; the first-arrival columns use
  ``arrival = (batch_id, file, position in file)``;
* every micro-batch observes its rows, rows per reject reason and time candidates in
  that one write and leaves them in ``metrics/batch_id=N``: :func:`streamed_metrics`
  are the load counters without a second pass over the data;
* :func:`stream_time_rows` follows the ledger with one state row per timeID (insert if
  absent, first arrival), so that the time dimension (:func:`inserted_time_dim`) is not
  computed from the whole ledger again;
* :func:`compact_ledger` folds committed batches into one snapshot so that
  readers stop re-reading the history; :func:`streamed_star` makes the
  stream-loaded fact and time dimension queryable with the catalogue;
  :func:`live_fact_totals` is the update-mode alternative for live serving.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesloom.operators.dims import dim_time
from salesloom.functions.calendar import time_parts
from salesloom.operators.enrich import (REASONS, accepted_facts, customer_keys, enrich_with_masters,
                                       product_master)
from salesloom.operators.fact import collapse_fact, fact_totals, overflowed_keys
from salesloom.operators.joins import broadcastable, tasks_for
from salesloom.plans.star import (PART_BUCKET, PART_YEAR, _write_manifest, key_bucket, manifest_rows,
                                  new_hash_buckets, put_fact, read_star, table_locations)
from salesloom.schemas import TIME_COLUMNS, WIDE_MONEY
from salesloom.sources.transactions import DEFAULT_HEADER, PARSE_REASONS, parse_transactions


MASTERS = ("product_master", "customer_keys")


def write_masters(staging: DataFrame, suppliers: DataFrame, stores: DataFrame,
                  customers: DataFrame, path: str) -> None:
    """Write the two lookups the loader reads (the warehouse load writes
    the same two tables)."""
    product_master(staging, suppliers, stores).write.mode("overwrite").parquet(
        f"{path}/product_master")
    customer_keys(customers).write.mode("overwrite").parquet(f"{path}/customer_keys")


def _read_masters(spark: SparkSession, dims_path: str) -> tuple[dict, dict]:
    """The two lookups and their row counts.  A written warehouse is read
    through its manifest (current build, recorded counts); a folder made by
    :func:`write_masters` has no counts."""
    try:
        manifest = manifest_rows(spark, dims_path)
        rows = {r["source"]: int(r["rows"]) for r in manifest}
        locs = {r["source"]: r["location"] or r["build"] for r in manifest}
    except AnalysisException:
        rows, locs = {}, {n: dims_path for n in MASTERS}
    return {n: spark.read.parquet(f"{locs[n]}/{n}") for n in MASTERS}, rows


def batch_masters(parsed: DataFrame, masters: dict, rows: dict) -> tuple[DataFrame, DataFrame, dict]:
    """Lookups for one micro-batch, never shuffling a big master.

    A master whose recorded size is within the broadcast bound is broadcast
    whole.  Otherwise the batch's distinct keys are counted (one aggregate
    for both keys); when they are within the bound they are broadcast into
    a semi join that cuts the master down to the batch's keys while it is
    scanned, and the cut master (at most that many rows) is broadcast.
    Only when the batch itself holds more keys than the bound does the
    join stay a shuffle join.
    """
    master, ckeys = masters["product_master"], masters["customer_keys"]
    out = {"product": rows.get("product"), "customer": rows.get("customer")}
    need = [k for k in ("product", "customer") if not broadcastable(out[k])]
    if not need:
        return master, ckeys, out
    cols = {"product": "productID", "customer": "customerID"}
    got = parsed.agg(*[F.countDistinct(cols[k]).alias(k) for k in need]).first()
    for k in need:
        n = int(got[k])
        if broadcastable(n):
            keys = parsed.where(F.col(cols[k]).isNotNull()).select(cols[k]).distinct()
            if k == "product":
                master = master.join(F.broadcast(keys), cols[k], "left_semi")
            else:
                ckeys = ckeys.join(F.broadcast(keys), cols[k], "left_semi")
            out[k] = n
    return master, ckeys, out


COUNTERS = ("read", "loaded", "time_candidates", *PARSE_REASONS, *REASONS)
METRICS_SCHEMA = ", ".join(f"{c} bigint" for c in COUNTERS)


def _counters() -> list:
    """The aggregates that a load observes on its enriched rows, named as in ``COUNTERS``."""
    reason = F.col("reject_reason")
    return [F.count(F.lit(1)).alias("read"), F.count_if(reason.isNull()).alias("loaded"),
            F.count_if(F.col("time_ok")).alias("time_candidates"),
            *[F.count_if(reason == r).alias(r) for r in (*PARSE_REASONS, *REASONS)]]


def _admitted(reader, max_files: int | None, max_bytes: int | None):
    """The stream reader with what one trigger takes (bytes go before files)."""
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``, from their status only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def stream_fact(spark: SparkSession, input_path: str | DataFrame, dims_path: str, out_path: str,
                checkpoint: str, max_files: int | None = 1, header: str | None = DEFAULT_HEADER,
                available_now: bool = True, processing_time: str | None = None,
                max_bytes: int | None = None) -> StreamingQuery:
    """Start the loader; returns the running :class:`StreamingQuery`.

    ``input_path`` is a folder of transaction text files (read as a file
    stream) or an already built streaming
    DataFrame of lines with a ``value`` column (its source decides the
    throttle; arrival is then (batch, position)).  A trigger admits files of ``max_bytes``
    together where given (at least one file), else ``max_files`` files, else
    all that are there; the batch's tasks follow from its bytes.
    ``dims_path`` holds the ``product_master`` and ``customer_keys`` lookups
    (a written warehouse, or :func:`write_masters`); they are re-read for
    every micro-batch, so a reloaded master is picked up by the next batch.  With ``available_now`` the query
    drains the files present and stops (the reference's "stop when idle");
    otherwise it runs on ``processing_time`` triggers.
    """
    if isinstance(input_path, DataFrame):
        lines = input_path.select("value", F.lit("").alias("_file"))
    else:
        lines = (_admitted(spark.readStream.format("text"), max_files, max_bytes).load(input_path)
                 .select("value", F.col("_metadata.file_path").alias("_file")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("arrival", F.struct(F.lit(batch_id).cast("bigint").alias("batch"),
                                                 F.col("_file").alias("file"),
                                                 F.monotonically_increasing_id().alias("pos")))
        masters, counts = _read_masters(spark, dims_path)
        # the batch is read again only when its keys must be counted first; it is parsed once all the same
        twice = not all(broadcastable(counts.get(k)) for k in ("product", "customer"))
        parsed = parse_transactions(b.drop("_file"), header)
        if twice:
            parsed = parsed.persist()
        try:
            master, ckeys, rows = batch_masters(parsed, masters, counts)
            seen = Observation()
            enriched = enrich_with_masters(parsed, master, ckeys, rows).observe(seen, *_counters())
            enriched.write.mode("overwrite").parquet(f"{out_path}/ledger/batch_id={batch_id}")
            (spark.createDataFrame([tuple(seen.get[c] for c in COUNTERS)], METRICS_SCHEMA).coalesce(1)
             .write.mode("overwrite").parquet(f"{out_path}/metrics/batch_id={batch_id}"))
        finally:
            if twice:
                parsed.unpersist()

    w = (lines.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "10 seconds")
    return w.start()


def read_ledger(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(f"{out_path}/ledger")


def _compaction(spark: SparkSession, out_path: str) -> Row | None:
    """The last compaction: ``upto``, ``folder`` (its time rows), ``buckets``, ``parts``
    (hash bucket of the fact key -> folder of its rows) and ``rejects`` (folders), or None."""
    try:
        return (spark.read.parquet(f"{out_path}/compaction")
                .agg(F.max_by(F.struct("*"), F.struct("upto", "at", "folder")).alias("n")).select("n.*").first())
    except AnalysisException:
        return None


def _snapshot_facts(spark: SparkSession, parts: dict[int, str]) -> DataFrame | None:
    """Fact rows of the given snapshot buckets: one scan per compaction that wrote some in force."""
    folders: dict[str, list[str]] = {}
    for bucket, folder in parts.items():
        folders.setdefault(folder, []).append(f"{folder}/facts/{PART_BUCKET}={bucket}")
    scans = [spark.read.parquet(*sorted(paths)) for _, paths in sorted(folders.items())]
    return reduce(DataFrame.unionByName, scans) if scans else None


def _sources(spark: SparkSession, out_path: str) -> tuple[DataFrame, dict | None]:
    """Ledger rows after the last compaction, and the compacted snapshot."""
    led = read_ledger(spark, out_path)
    c = _compaction(spark, out_path)
    if c is None:
        return led, None
    snap = {"facts": _snapshot_facts(spark, c["parts"]), "time": spark.read.parquet(f"{c['folder']}/time"),
            "rejects": spark.read.parquet(*c["rejects"])}
    return led.where(F.col("batch_id") > F.lit(c["upto"])), snap


def _fact_rows(led: DataFrame, snap: dict | None) -> DataFrame:
    rows = accepted_facts(led).drop("batch_id")
    if snap is not None and snap["facts"] is not None:
        rows = snap["facts"].unionByName(rows.select(*snap["facts"].columns))
    return rows


def _time_rows(led: DataFrame, snap: dict | None) -> DataFrame:
    rows = led.where(F.col("time_ok")).select("timeID", "orderTS", "arrival")
    if snap is not None:
        rows = snap["time"].unionByName(rows)
    return rows


def _reject_rows(led: DataFrame, snap: dict | None) -> DataFrame:
    rows = led.where(F.col("reject_reason").isNotNull()).select("raw", "reject_reason", "batch_id")
    if snap is not None:
        rows = snap["rejects"].unionByName(rows)
    return rows


def streamed_fact(spark: SparkSession, out_path: str) -> DataFrame:
    """The fact table as of the batches committed so far."""
    rows = _fact_rows(*_sources(spark, out_path))
    return collapse_fact(rows, tasks=tasks_for(spark, rows.count()))


def streamed_overflow(spark: SparkSession, out_path: str) -> DataFrame:
    """Keys whose total does not fit the fact, with their whole total."""
    return overflowed_keys(fact_totals(_fact_rows(*_sources(spark, out_path))))


def streamed_rejects(spark: SparkSession, out_path: str) -> DataFrame:
    """Every quarantined line with its reason (parse or enrichment)."""
    led, snap = _sources(spark, out_path)
    return _reject_rows(led, snap)


def streamed_time_dim(spark: SparkSession, out_path: str) -> DataFrame:
    """Time dimension from all committed batches (first parseable arrival;
    arrival starts with the batch id)."""
    led, snap = _sources(spark, out_path)
    return dim_time(_time_rows(led, snap))


def streamed_metrics(spark: SparkSession, out_path: str) -> DataFrame:
    """``counter, rows``: what the committed batches observed while they were written.  A
    replayed batch replaces its counters as it replaces its rows."""
    sums = spark.read.parquet(f"{out_path}/metrics").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return sums.unpivot([], list(COUNTERS), "counter", "rows").where(F.col("rows").isNotNull())


def stream_time_rows(spark: SparkSession, out_path: str, checkpoint: str, max_files: int | None = None,
                     max_bytes: int | None = None, available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    """Insert-if-absent of the time dimension as a stream over the ledger's batches.

    The state is one row per timeID, so bounded by the calendar, kept by Spark's state store
    and restored from ``checkpoint``: the first candidate by (batch, file, position)
    and the trigger that saw it.  A trigger emits only the timeIDs that it sees for the first
    time, and ``time_rows/batch_id=N`` (overwritten by a replay) takes them; no
    trigger reads an older ledger batch again.  A candidate that arrived before
    the stored one but is listed later is emitted as well, and
    :func:`inserted_time_dim` takes the earlier.  Run it on committed batches: after the loader
    in ``available_now`` mode, or beside it on its own ``processing_time``.
    """
    reader = _admitted(spark.readStream.schema(read_ledger(spark, out_path).schema)
                       .option("ignoreMissingFiles", "true"), max_files, max_bytes)
    candidates = (reader.parquet(f"{out_path}/ledger").where(F.col("time_ok"))
                  .select("timeID", F.struct("arrival", "orderTS", F.current_timestamp().alias("trigger")).alias("c")))
    fresh = (candidates.groupBy("timeID").agg(F.min("c").alias("c"))
             .where(F.col("c.trigger") == F.current_timestamp()).select("timeID", "c.arrival", "c.orderTS"))

    def insert(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/time_rows/batch_id={batch_id}")

    w = (fresh.writeStream.outputMode("update").foreachBatch(insert).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def inserted_time_dim(spark: SparkSession, out_path: str) -> DataFrame:
    """The time dimension as :func:`stream_time_rows` has inserted it."""
    rows = spark.read.parquet(f"{out_path}/time_rows")
    first = rows.groupBy("timeID").agg(F.min_by("orderTS", "arrival").alias("orderTS"))
    return first.select("timeID", *time_parts("orderTS")).select(*TIME_COLUMNS)


def compact_ledger(spark: SparkSession, out_path: str, upto: int) -> None:
    """Fold ledger batches up to ``upto`` (a committed batch id, e.g. from
    ``query.lastProgress``) into one snapshot, so readers stop re-reading
    the history.

    The snapshot holds one fact row per key with the key's earliest arrival
    (so first-arrival columns stay right when later batches are added) and wide
    totals, the first candidate per timeID, and every reject.  Its fact rows are kept by
    hash bucket of the fact key: a compaction reads and writes only the buckets that the
    folded batches hold keys of, and the record lists the folder of every
    bucket; rejects are only added, and time rows (bounded by the calendar) written
    anew.  Everything goes to a new folder and the record is added to ``compaction`` last,
    so a compaction that dies halfway is ignored and the earlier one stays in force.  Batch folders
    up to ``upto`` are then skipped by partition pruning.
    """
    last = _compaction(spark, out_path)
    led = read_ledger(spark, out_path).where(F.col("batch_id") <= F.lit(upto))
    if last:
        led = led.where(F.col("batch_id") > F.lit(last["upto"]))
    n = last["buckets"] if last else new_hash_buckets(spark)
    parts = dict(last["parts"]) if last else {}
    folder = f"{out_path}/compacted/upto={upto}-{uuid.uuid4().hex[:8]}"
    touched = {r[0] for r in accepted_facts(led).select(key_bucket(n)).distinct().collect()}   # at most n
    stored = _snapshot_facts(spark, {b: f for b, f in parts.items() if b in touched})
    facts = (_fact_rows(led, {"facts": stored}).groupBy("orderID", "productID", "customerID")
             .agg(F.min_by(F.struct("supplierID", "storeID", "orderDate", "timeID"),
                           "arrival").alias("_f"),
                  F.sum(F.col("quantityOrdered").cast("bigint")).alias("quantityOrdered"),
                  F.sum(F.col("totalSale").cast(WIDE_MONEY)).cast(WIDE_MONEY).alias("totalSale"),
                  F.min("arrival").alias("arrival"))
             .select("orderID", "productID", "customerID", "_f.supplierID", "_f.storeID",
                     "_f.orderDate", "_f.timeID", "quantityOrdered", "totalSale", "arrival"))
    (facts.withColumn(PART_BUCKET, key_bucket(n)).hint("rebalance", PART_BUCKET)
     .write.mode("overwrite").partitionBy(PART_BUCKET).parquet(f"{folder}/facts"))
    times = {"time": spark.read.parquet(f"{last['folder']}/time")} if last else None
    time = (_time_rows(led, times).groupBy("timeID")
            .agg(F.min_by("orderTS", "arrival").alias("orderTS"), F.min("arrival").alias("arrival")))
    time.write.mode("overwrite").parquet(f"{folder}/time")
    _reject_rows(led, None).write.mode("overwrite").parquet(f"{folder}/rejects")
    rejects = [*(last["rejects"] if last else []), f"{folder}/rejects"]
    parts.update({b: folder for b in touched})
    (spark.createDataFrame([(upto, folder, n, parts, rejects)],
                           "upto bigint, folder string, buckets int, parts map<int,string>, rejects array<string>")
     .withColumn("at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(f"{out_path}/compaction"))


def live_fact_totals(spark: SparkSession, input_path: str | DataFrame, dims_path: str,
                     max_files: int = 1,
                     header: str | None = DEFAULT_HEADER, watermark: str | None = None,
                     state_window: str = "1 day") -> DataFrame:
    """Streaming additive totals per fact key, for an ``update``-mode sink.

    The live-serving alternative to the ledger: Spark keeps one state row per
    (orderID, productID, customerID) and emits the changed totals each
    trigger.  The state has no time bound (keys never expire, as in the
    upsert table it replaces), so it grows with the number of distinct keys;
    the ledger path is the one to use for the full history.  First-arrival
    columns order rows by (file modification time, file path, orderTS); for
    a DataFrame of lines, by (processing time of the batch, orderTS).

    With ``watermark`` (off by default) the state is kept per key and
    ``state_window`` of order time (a ``window`` output column) and dropped
    once the window is older than the watermark; rows arriving later than
    that are ignored.  This bounds the state, at the price of the late-row
    rule of the source (late rows are always added).
    """
    if isinstance(input_path, DataFrame):      # a streaming DataFrame of lines
        lines = input_path.select("value", F.struct(F.current_timestamp().alias("t"),
                                                    F.lit("").alias("f")).alias("arrival"))
    else:
        lines = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
                 .load(input_path)
                 .select("value", F.struct(F.col("_metadata.file_modification_time").alias("t"),
                                           F.col("_metadata.file_path").alias("f"))
                         .alias("arrival")))
    m, _ = _read_masters(spark, dims_path)
    parsed = parse_transactions(lines, header)
    parsed = parsed.withColumn("arrival", F.struct(F.col("arrival").alias("src"), "orderTS"))
    enriched = enrich_with_masters(parsed, m["product_master"], m["customer_keys"])
    if watermark is None:
        return collapse_fact(accepted_facts(enriched))
    acc = enriched.where(F.col("reject_reason").isNull()).withWatermark("orderTS", watermark)
    return collapse_fact(acc, [F.window("orderTS", state_window)])


def streamed_star(spark: SparkSession, warehouse: str, out_path: str, path: str) -> "Star":
    """A queryable star whose fact and time dimension come from the stream.

    The dimensions are the warehouse's; the fact (collapsed ledger, with its
    year partition) and the time dimension are written as a new warehouse
    build under ``path``, so every query of the catalogue runs on the
    stream-loaded data exactly as on a batch-loaded warehouse; rejects, overflowed
    keys and the warehouse's lookups come with it, so it can be appended to.
    """
    locs = {n: loc for n, loc in table_locations(spark, warehouse).items()
            if n in ("product", "supplier", "store", "customer", "staging", *MASTERS)}
    build = f"{path}/build-{uuid.uuid4().hex[:12]}"

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{build}/{name}")

    put(streamed_time_dim(spark, out_path), "time")
    time = spark.read.parquet(f"{build}/time")
    year = time.select("timeID", F.col("Year").alias(PART_YEAR))
    rows = _fact_rows(*_sources(spark, out_path))
    put_fact(spark, build, fact_totals(rows, tasks=tasks_for(spark, rows.count())), year, time.count(),
             new_hash_buckets(spark))
    put(streamed_rejects(spark, out_path), "fact_rejects")
    # the dimensions stay in the warehouse build: the manifest records where each table lives
    specs = {r["source"]: r["bucket_spec"] for r in manifest_rows(spark, warehouse)
             if r["bucket_spec"] and r["source"] in locs}
    locs |= {n: build for n in ("fact", "time", "fact_rejects", "fact_overflow")}
    _write_manifest(spark, path, build, locs, specs)
    return read_star(spark, path)
