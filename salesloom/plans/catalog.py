"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every entry reads the provided tables (through the warehouse that Spark
builds from them) and runs over all of their rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.dims import dim_product, dim_store, dim_supplier, dim_time
from salesloom.operators.enrich import accepted_facts, enrich_transactions, fact_rejects
from salesloom.operators.fact import FACT_KEY, collapse_fact
from salesloom.operators.joins import tasks_for
from salesloom.operators.quality import (constrained, constraint_violations, fk_violations, key_violations,
                                         load_metrics)
from salesloom.plans import queries as Q
from salesloom.plans.star import load_warehouse, unreduced, warehouse_path
from salesloom.session import shared_dir
from salesloom.sources.tables import (DELIVERIES, customers_from_tables, event_delivery_lines, event_transaction_lines,
                                      event_transactions,
                                      product_staging_from_tables, raw_lines, strict_masters,
                                      transaction_lines, transactions_from_tables)
from salesloom.sources.transactions import parse_transactions, time_candidates, txn_rejects
from salesloom.streaming.fact_stream import (input_bytes, inserted_time_dim, stream_fact, stream_time_rows, streamed_fact,
                                              streamed_metrics, streamed_rejects, streamed_time_dim)

# the provided orders span 1995-2001 (no 2019): the year-restricted queries use 1998
TEST_YEAR = 1998

Query = Callable[[SparkSession, str], DataFrame]


def _w(fn) -> Query:
    return lambda spark, sf_dir: fn(load_warehouse(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = product_staging_from_tables(spark, sf_dir)
    return enrich_transactions(transactions_from_tables(spark, sf_dir), staging,
                               dim_supplier(staging), dim_store(staging),
                               customers_from_tables(spark, sf_dir))


def q_parse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_transactions(transaction_lines(spark, sf_dir))
    return p.select("orderID", "productID", "quantityOrdered", "customerID", "orderDate",
                    "orderTime", "timeID", "reject_reason")


def q_txn_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_rejects(parse_transactions(transaction_lines(spark, sf_dir)))


def q_time_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = time_candidates(transaction_lines(spark, sf_dir))
    return c.select("timeID", F.date_format("orderTS", "yyyy-MM-dd HH:mm:ss").alias("orderTS"))


def q_enrich_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = accepted_facts(_enriched(spark, sf_dir))
    return e.drop("arrival").withColumn("totalSale", F.col("totalSale").cast("double"))


def q_fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rejects(_enriched(spark, sf_dir)).withColumn(
        "totalSale", F.col("totalSale").cast("double"))


def q_collapse_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = load_warehouse(spark, sf_dir).fact_rows()
    return f.withColumn("totalSale", F.col("totalSale").cast("double"))


BATCHES, LEAST_BATCH_BYTES = 16, 8 << 20


def _new_run(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"


def _load(spark: SparkSession, sf_dir: str, run: str, max_bytes: int | None = None) -> None:
    """Drain ``run/input`` through the loader (from its checkpoint, if it ran before) against
    the warehouse, ``max_bytes`` per trigger, or all that is there as one batch."""
    stream_fact(spark, f"{run}/input", warehouse_path(spark, sf_dir), f"{run}/out", f"{run}/checkpoint",
                max_files=None, max_bytes=max_bytes).awaitTermination()


def _stream_lines(spark: SparkSession, sf_dir: str, lines: DataFrame, batch_bytes: int | None = None) -> str:
    """Write ``lines`` as text in a fresh folder and load them; returns the output folder.

    The files are the tasks of the lines' own plan and a micro-batch takes ``batch_bytes``, by default a
    sixteenth of what was written (8 MB at least), so both grow with the input.  On a cluster, set it to 1-10 GB."""
    load_warehouse(spark, sf_dir)
    run = _new_run(spark)
    lines.select("value").write.text(f"{run}/input")
    _load(spark, sf_dir, run, batch_bytes or max(LEAST_BATCH_BYTES, input_bytes(spark, f"{run}/input") // BATCHES))
    return f"{run}/out"


def q_stream_fact(spark: SparkSession, sf_dir: str, batch_bytes: int | None = None) -> DataFrame:
    """The fact collapsed from the ledger of the transactions streamed as text."""
    out = _stream_lines(spark, sf_dir, transaction_lines(spark, sf_dir), batch_bytes)
    return streamed_fact(spark, out).withColumn("totalSale", F.col("totalSale").cast("double"))


def _stream_events(spark: SparkSession, sf_dir: str) -> str:
    """The purchase events streamed as transaction text."""
    return _stream_lines(spark, sf_dir, event_transaction_lines(spark, sf_dir))


def _stream_deliveries(spark: SparkSession, sf_dir: str) -> str:
    """All events in ``DELIVERIES`` deliveries, each written in order of event_id and drained by a loader
    and a time stream that start again from their checkpoints; returns the output folder."""
    load_warehouse(spark, sf_dir)
    run = _new_run(spark)
    lines = event_delivery_lines(spark, sf_dir)
    for d in range(DELIVERIES):
        (lines.where(F.col("delivery") == d).repartitionByRange("event_id").sortWithinPartitions("event_id")
         .select("value").write.mode("append").text(f"{run}/input"))
        _load(spark, sf_dir, run)
        stream_time_rows(spark, f"{run}/out", f"{run}/time_checkpoint").awaitTermination()
    return f"{run}/out"


def q_stream_first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the deliveries: dates of the first arrival of each key, totals over all."""
    out = _stream_deliveries(spark, sf_dir)
    return streamed_fact(spark, out).withColumn("totalSale", F.col("totalSale").cast("double"))


def q_stream_time_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time dimension of the deliveries, inserted if absent from the stream's state."""
    return inserted_time_dim(spark, _stream_deliveries(spark, sf_dir))


def q_stream_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the loader observed while it loaded the deliveries' lines and the lines that do not parse."""
    lines = event_delivery_lines(spark, sf_dir).select("value").unionByName(raw_lines(spark, sf_dir).select("value"))
    return streamed_metrics(spark, _stream_lines(spark, sf_dir, lines))


def q_stream_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _stream_events(spark, sf_dir)
    return streamed_fact(spark, out).withColumn("totalSale", F.col("totalSale").cast("double"))


def q_stream_rejects_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _stream_events(spark, sf_dir)
    return (streamed_rejects(spark, out).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("rows")))


def q_stream_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed_time_dim(spark, _stream_events(spark, sf_dir))


def q_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_time(transactions_from_tables(spark, sf_dir).select("timeID", "orderTS", "arrival"))


def q_txn_key_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").count()      # footers
    return key_violations(transactions_from_tables(spark, sf_dir), FACT_KEY, tasks_for(spark, lines))


def q_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load_warehouse(spark, sf_dir)
    return fk_violations(s.fact_rows(), {"productID": s.product, "customerID": s.customer, "supplierID": s.supplier,
                                         "storeID": s.store, "timeID": s.time}, FACT_KEY)


def q_document_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label refers to, and those without a vector of that number."""
    read = lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    docs = read("documents").select("doc_id", F.col("doc_id").alias("vec_id"))
    return fk_violations(docs, {"doc_id": read("labels"), "vec_id": read("embeddings")}, ["doc_id"])


def q_raw_line_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark, sf_dir).withColumnRenamed("source", "arrival")
    p = parse_transactions(lines).withColumnRenamed("arrival", "source")
    return p.where(F.col("reject_reason").isNotNull()).select("source", "raw", "reject_reason")


def q_enrichment_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = enrich_transactions(event_transactions(spark, sf_dir), *strict_masters(spark, sf_dir))
    return fact_rejects(e).select("orderID", "productID", "customerID", "supplierID", "storeID", "quantityOrdered", "reject_reason")


def q_stream_line_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not parse, streamed through the loader: the quarantine by reason."""
    out = _stream_lines(spark, sf_dir, raw_lines(spark, sf_dir))
    return (streamed_rejects(spark, out).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.char_length("raw")).alias("letters")))


def q_part_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    return constraint_violations(part, unique=["p_partkey", "p_name"], lengths={"p_name": 10, "p_brand": 10, "p_type": 10})


def q_part_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of parts by UNIQUE and at most ten-letter names would quarantine."""
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet").select("p_partkey", "p_name", "p_size")
    return constrained(part, "p_partkey", unique=["p_name"], lengths={"p_name": 10})[1]


def q_dim_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load_warehouse(spark, sf_dir)
    checks = [(unreduced(s, d), f"{d}{k}") for d in ("product", "supplier", "store", "customer") for k in ("ID", "Name")]
    checks.append((s.time, "timeID"))
    parts = [key_violations(d, [k]).select(F.lit(k).alias("key"),
                                           F.col(k).cast("string").alias("value"), "rows")
             for d, k in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load_warehouse(spark, sf_dir)
    return load_metrics({"fact": s.fact, "time": s.time, "product": s.product,
                         "supplier": s.supplier, "store": s.store, "customer": s.customer})


def _staging(spark, sf_dir):
    return product_staging_from_tables(spark, sf_dir).withColumn(
        "productPrice", F.col("productPrice").cast("double"))


QUERIES: dict[str, Query] = {
    "q1_top_products_daytype": _w(lambda s: Q.q1_top_products_daytype(s, TEST_YEAR)),
    "q1_drilldown": _w(lambda s: Q.q1_drilldown(s, TEST_YEAR)),
    "q2_store_quarter_growth": _w(lambda s: Q.q2_store_quarter_growth(s, TEST_YEAR)),
    "q3_supplier_contribution": _w(Q.q3_supplier_contribution),
    "q4_seasonal_sales": _w(Q.q4_seasonal_sales),
    "q5_monthly_volatility": _w(Q.q5_monthly_volatility),
    "q6_product_affinity": _w(Q.q6_product_affinity),
    "q6_affinity_same_visit": _w(Q.q6_affinity_same_visit),
    "q7_revenue_rollup": _w(Q.q7_revenue_rollup),
    "q8_half_year_sales": _w(Q.q8_half_year_sales),
    "q9_outlier_days": _w(Q.q9_outlier_days),
    "q10_store_quarterly_sales": _w(Q.q10_store_quarterly_sales),
    "enriched_sales": _w(Q.enriched_sales),
    "revenue_by_customer_segment": _w(Q.revenue_by_customer_segment),
    "product_staging": _staging,
    "dim_product": lambda spark, d: dim_product(product_staging_from_tables(spark, d)).withColumn(
        "productPrice", F.col("productPrice").cast("double")),
    "dim_supplier": lambda spark, d: dim_supplier(product_staging_from_tables(spark, d)),
    "dim_store": lambda spark, d: dim_store(product_staging_from_tables(spark, d)),
    "dim_time": q_dim_time,
    "parse_transactions": q_parse_transactions,
    "txn_rejects": q_txn_rejects,
    "time_candidates": q_time_candidates,
    "enrich_transactions": q_enrich_transactions,
    "fact_rejects": q_fact_rejects,
    "collapse_fact": q_collapse_fact,
    "stream_fact": q_stream_fact,
    "stream_fact_events": q_stream_fact_events,
    "stream_rejects_events": q_stream_rejects_events,
    "stream_time_events": q_stream_time_events,
    "stream_first_arrivals": q_stream_first_arrivals,
    "stream_time_inserts": q_stream_time_inserts,
    "stream_load_metrics": q_stream_load_metrics,
    "txn_key_repeats": q_txn_key_repeats,
    "fk_violations": q_fk_violations,
    "dim_key_violations": q_dim_key_violations,
    "document_fk_violations": q_document_fk_violations,
    "raw_line_rejects": q_raw_line_rejects,
    "enrichment_rejects": q_enrichment_rejects,
    "stream_line_rejects": q_stream_line_rejects,
    "part_constraints": q_part_constraints,
    "part_rejects": q_part_rejects,
    "load_metrics": q_load_metrics,
}
