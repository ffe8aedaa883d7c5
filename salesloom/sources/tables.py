"""The provided TPC-H-like tables seen as the warehouse's inputs.

Mapping (one transaction per lineitem):

* orderID, productID, customerID  <- l_orderkey, l_partkey, o_custkey
* quantityOrdered                 <- l_quantity (whole numbers)
* order timestamp                 <- o_orderdate (midnight); timeID = yyyyMMdd
* arrival order                   <- (l_linenumber, l_shipdate, l_suppkey)
* product staging row per part:   name = p_name + ' #' + p_partkey (p_name
  repeats), price = p_retailprice as DECIMAL(10,2), supplier = the supplier
  of the part's first line by (l_orderkey, l_linenumber, l_suppkey), store =
  that supplier's nation.
* customer: c_custkey, c_name; the customer's ``gender`` column carries
  c_mktsegment (the tables have no gender).

These functions only shape rows into the schema the jobs expect; the jobs
themselves (parse, enrich, collapse, ...) live in ``operators``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.schemas import MONEY


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that arrives in fewer splits than the cluster has
    cores (e.g. one file with one row group) so the work after it runs in
    parallel.  Key-free on purpose: a hot key cannot make one partition big,
    and the joins and aggregations after it keep their own exchanges (and
    AQE's skew handling).  A scan with enough splits is left alone."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        few = df.rdd.getNumPartitions() < cores
    except Exception:          # sessions without RDD access (e.g. Spark Connect)
        return df
    return df.repartition(cores) if few else df


def transactions_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions: orderID, productID, quantityOrdered, customerID,
    orderTS, timeID, arrival (the accepted shape of ``parse_transactions``)."""
    li = spread(_t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    d = F.to_date("o_orderdate")
    return j.select(
        F.col("l_orderkey").alias("orderID"),
        F.col("l_partkey").alias("productID"),
        F.col("l_quantity").cast("int").alias("quantityOrdered"),
        F.col("o_custkey").alias("customerID"),
        F.col("o_orderdate").alias("orderTS"),
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint").alias("timeID"),
        F.struct("l_linenumber", "l_shipdate", "l_suppkey").alias("arrival"),
    )


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same transactions rendered as text lines of the file layout."""
    t = transactions_from_tables(spark, sf_dir)
    value = F.concat_ws(",", F.col("orderID").cast("string"), F.col("productID").cast("string"),
                        F.col("quantityOrdered").cast("string"),
                        F.col("customerID").cast("string"),
                        F.date_format("orderTS", "M/d/yyyy"), F.date_format("orderTS", "h:mm a"),
                        F.col("timeID").cast("string"))
    return t.select(value.alias("value"), "arrival")


def product_staging_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denormalised product file: product, price, supplier, store."""
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")
    first = (li.groupBy("l_partkey")
             .agg(F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey")).alias("m"))
             .select(F.col("l_partkey").alias("productID"), F.col("m.l_suppkey").alias("supplierID")))
    part = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("productID"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("productName"),
        F.col("p_retailprice").cast(MONEY).alias("productPrice"))
    supp = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplierID"), F.col("s_name").alias("supplierName"),
        F.col("s_nationkey").cast("bigint").alias("storeID"))
    nation = _t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("storeID"), F.col("n_name").alias("storeName"))
    return (part.join(first, "productID", "left")
            .join(supp, "supplierID", "left")
            .join(nation, "storeID", "left")
            .select("productID", "productName", "productPrice", "supplierID", "supplierName",
                    "storeID", "storeName"))


def customers_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerID"), F.col("c_name").alias("customerName"),
        F.col("c_mktsegment").alias("gender"))


def event_transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events rendered as transaction text lines (real times of day).

    Shaping only: orderID <- event_id, productID <- the ``k`` of ``props``,
    quantityOrdered <- ceil(value), customerID <- user_id, date and time <-
    ts, timeID <- ts as yyyyMMddHHmm (the text keeps minutes).  Ids that have
    no product or customer stay as they are; the loader quarantines them.
    """
    e = _t(spark, sf_dir, "events").where(F.col("event_type") == F.lit("purchase"))
    value = F.concat_ws(",", F.col("event_id").cast("string"),
                        F.get_json_object("props", "$.k"),
                        F.ceil("value").cast("int").cast("string"),
                        F.col("user_id").cast("string"),
                        F.date_format("ts", "M/d/yyyy"), F.date_format("ts", "h:mm a"),
                        F.date_format("ts", "yyyyMMddHHmm"))
    return e.select(value.alias("value"))


DELIVERIES = 3


def event_delivery_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as transaction text lines in which keys come back on other dates: orderID and
    customerID <- user_id, productID <- the ``k`` of ``props``, timeID <- the day.  ``delivery``
    (0 to ``DELIVERIES`` - 1) is the part of the month that the event came in, latest part first, so that
    the first to arrive is not the earliest by date; ``event_id`` orders a delivery's lines."""
    e = _t(spark, sf_dir, "events")
    value = F.concat_ws(",", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"),
                        F.ceil("value").cast("int").cast("string"), F.col("user_id").cast("string"),
                        F.date_format("ts", "M/d/yyyy"), F.date_format("ts", "h:mm a"), F.date_format("ts", "yyyyMMdd"))
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(DELIVERIES - 1))
    return e.select((F.lit(DELIVERIES - 1) - part).cast("int").alias("delivery"), "event_id", value.alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines (``value``) that no loader wrote, with their ``source``: every line of the documents'
    texts, and all events as transaction text with an unrounded quantity (``events_value``) or an
    ISO date (``events_iso``).  Reject paths are shown on them."""
    e = spread(_t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props"))
    ids = [F.col("event_id").cast("string"), F.get_json_object("props", "$.k")]
    rest = [F.col("user_id").cast("string"), F.date_format("ts", "M/d/yyyy"), F.date_format("ts", "h:mm a"),
            F.date_format("ts", "yyyyMMddHHmm")]
    value = F.concat_ws(",", *ids, F.col("value").cast("decimal(12,4)").cast("string"), *rest)
    iso = F.concat_ws(",", *ids, F.ceil("value").cast("int").cast("string"), rest[0], F.date_format("ts", "yyyy-MM-dd"), *rest[2:])
    lines = spread(_t(spark, sf_dir, "documents").select("text")).select(F.explode(F.split("text", "\n", -1)).alias("value"))
    return (lines.select(F.lit("documents").alias("source"), "value")
            .unionByName(e.select(F.lit("events_value").alias("source"), value.alias("value")))
            .unionByName(e.select(F.lit("events_iso").alias("source"), iso.alias("value"))))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as typed transactions, with a quantity of thousands of their value."""
    e = _t(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("orderID"), F.get_json_object("props", "$.k").cast("bigint").alias("productID"),
                    F.ceil(F.col("value") * 1000).cast("int").alias("quantityOrdered"), F.col("user_id").alias("customerID"),
                    F.col("ts").alias("orderTS"), F.date_format("ts", "yyyyMMddHHmm").cast("bigint").alias("timeID"))


def strict_masters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(staging, suppliers, stores, customers) of a stricter load, which leaves keys without
    match: parts of size above 5, suppliers and customers not in debt, nations outside region 0."""
    parts = _t(spark, sf_dir, "part").where("p_size > 5").select(F.col("p_partkey").alias("productID"))
    suppliers = _t(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(
        F.col("s_suppkey").alias("supplierID"), F.col("s_name").alias("supplierName"))
    stores = _t(spark, sf_dir, "nation").where("n_regionkey <> 0").select(
        F.col("n_nationkey").cast("bigint").alias("storeID"), F.col("n_name").alias("storeName"))
    customers = _t(spark, sf_dir, "customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("customerID"), F.col("c_name").alias("customerName"), F.col("c_mktsegment").alias("gender"))
    return product_staging_from_tables(spark, sf_dir).join(parts, "productID", "left_semi"), suppliers, stores, customers
