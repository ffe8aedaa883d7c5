"""The star: one fact and five dimensions, built and written once.

``build_star`` declares the whole load as one lazy plan from the provided
tables: product staging -> product/supplier/store dimensions, transactions
-> time dimension, transactions -> enrichment (with quarantine) ->
additive collapse -> fact.  ``load_warehouse`` writes every table as
Parquet into a fresh build folder under the shared folder (the fact
partitioned by the year of its time row, for partition pruning, and by a hash
bucket of its key, the unit that appends rewrite; optionally
fact and product bucketed on productID instead and registered in the session
catalog, for co-located product joins), records row counts in a manifest
written last,
and returns a :class:`Star` over the written tables.  Queries then read the
written tables, and dimension joins use the recorded counts to decide on a
broadcast.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from salesloom.operators.dims import (DIM_COLUMNS, NULL_KEY, REPEATED_KEY, dim_candidates, dim_product,
                                     dim_rejects, dim_store, dim_supplier, dim_time, merge_time_dim,
                                     one_per_key)
from salesloom.operators.enrich import (accepted_facts, customer_keys, enrich_transactions,
                                       enrich_with_masters, fact_rejects, product_master)
from salesloom.operators.fact import (FACT_KEY, collapse_fact, fact_totals, fitting, overflowed_keys,
                                      overflows)
from salesloom.operators.joins import join_dim, tasks_for
from salesloom.operators.quality import load_metrics
from salesloom.session import shared_dir
from salesloom.sources.seeds import accepted, csv_rejects, land, read_customers, read_products
from salesloom.sources.tables import (customers_from_tables, product_staging_from_tables,
                                      transactions_from_tables)
from salesloom.sources.transactions import parse_transactions, read_transaction_lines

PART_YEAR = "part_year"
# Hash bucket of the fact key: an append or a compaction reads and rewrites only the
# buckets of its keys.  The number is fixed when a warehouse is built (`fact_parts` holds
# it); the session setting gives it for new builds.
PART_BUCKET = "part_bucket"
HASH_BUCKETS = 8
HASH_BUCKETS_CONF = "salesloom.hashBuckets"
DIMS = ("time", "product", "supplier", "store", "customer", "staging")
LOOKUPS = ("product_master", "customer_keys")
DIM_REJECTS = tuple(f"{d}_rejects" for d in (*DIM_COLUMNS, "customer"))
# Opt-in: with the session setting salesloom.factBuckets = N, the fact and the
# product dimension are bucketed on this key into N buckets, so product-level
# queries join and aggregate without shuffling the fact.  Off by default: a
# bucketed scan reads each bucket in one task, so a product holding a large
# share of the sales would make one task scan that share in every such query,
# while the unbucketed plan splits the scan and pre-aggregates before the
# shuffle.  Turn it on only for sales spread over many products.
BUCKET_KEY = "productID"
BUCKETS_CONF = "salesloom.factBuckets"
BUCKETED = ("fact", "product")


@dataclass
class Star:
    fact: DataFrame
    time: DataFrame
    product: DataFrame
    supplier: DataFrame
    store: DataFrame
    customer: DataFrame
    staging: DataFrame | None = None
    rows: dict = field(default_factory=dict)
    extra: dict = field(default_factory=dict)

    def fact_for_year(self, year: int) -> DataFrame:
        """The fact, pruned to one year's partition when it is partitioned."""
        if PART_YEAR in self.fact.columns:
            return self.fact.where(F.col(PART_YEAR) == F.lit(year))
        return self.fact

    def fact_rows(self) -> DataFrame:
        """The fact with its table columns only."""
        return self.fact.drop(PART_YEAR, PART_BUCKET)


def unreduced(star: Star, dim: str) -> DataFrame:
    """The rows that a written dimension was reduced to one per key from (of the
    staging's dimensions those with a key, as their loads take no others)."""
    rows = getattr(star, dim)
    reasons = [REPEATED_KEY] if dim in DIM_COLUMNS else [REPEATED_KEY, NULL_KEY]
    left_out = star.extra[f"{dim}_rejects"].where(F.col("reject_reason").isin(reasons))
    return rows.unionByName(left_out.select(*rows.columns))


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    """The whole warehouse load as lazy DataFrames over the provided tables
    (no writes; for small inputs and tests).  See :func:`write_warehouse`."""
    staging = product_staging_from_tables(spark, sf_dir)
    customers = customers_from_tables(spark, sf_dir)
    suppliers, stores = dim_supplier(staging), dim_store(staging)
    enriched = enrich_transactions(_typed_transactions(spark, sf_dir), staging, suppliers,
                                   stores, customers)
    time = dim_time(time_input(enriched))
    fact = collapse_fact(accepted_facts(enriched))
    return Star(fact=fact, time=time, product=dim_product(staging), supplier=suppliers,
                store=stores, customer=customers, staging=staging,
                extra={"fact_rejects": fact_rejects(enriched)})


def _typed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions_from_tables(spark, sf_dir)
    return t.withColumn("time_ok", F.col("timeID").isNotNull() & F.col("orderTS").isNotNull())


def time_input(ledger: DataFrame) -> DataFrame:
    """Time-dimension candidates held in a ledger of enriched rows."""
    return ledger.where(F.col("time_ok")).select("timeID", "orderTS", "arrival")


def _code_hash() -> str:
    h = hashlib.sha1()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()


def _input_key(spark: SparkSession, sf_dir: str) -> str:
    """Changes with the code and with path, size or time of any input file, on every
    file system that Spark reads (no content is read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
             .select("path", "length", "modificationTime"))
    seen = files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return hashlib.sha1(f"{sf_dir.rstrip('/')} {tuple(seen)} {_code_hash()}".encode()).hexdigest()[:16]


def warehouse_path(spark: SparkSession, sf_dir: str) -> str:
    layout = f"b{_bucket_count(spark) or 0}"
    return f"{shared_dir(spark)}/warehouse/{_input_key(spark, sf_dir)}-{layout}"


def _new_build(path: str) -> str:
    return f"{path}/build-{uuid.uuid4().hex[:12]}"


def _bucket_count(spark: SparkSession) -> int | None:
    v = spark.conf.get(BUCKETS_CONF, None)
    return int(v) if v not in (None, "", "0") else None


def new_hash_buckets(spark: SparkSession) -> int:
    """Number of hash buckets of a warehouse or snapshot built now."""
    return int(spark.conf.get(HASH_BUCKETS_CONF, None) or HASH_BUCKETS)


def key_bucket(n: int) -> Column:
    """Hash bucket of a row's fact key, 0 to n - 1."""
    return F.pmod(F.xxhash64(*FACT_KEY), F.lit(n)).cast("int")


def _put(spark: SparkSession, build: str, df: DataFrame, name: str, *partition: str) -> DataFrame:
    df.write.mode("overwrite").partitionBy(*partition).parquet(f"{build}/{name}")
    return spark.read.schema(df.schema).parquet(f"{build}/{name}")   # no files if there are no rows


def _put_bucketed(spark: SparkSession, build: str, df: DataFrame, name: str,
                  buckets: int | None, partition: str | None = None,
                  sort: bool = False) -> DataFrame:
    if buckets is None:
        return _put(spark, build, df, name, *([partition] if partition else []))
    # one task per bucket, so each task writes one file per partition
    w = (df.repartition(buckets, BUCKET_KEY).write.mode("overwrite")
         .option("path", f"{build}/{name}"))
    if partition:
        w = w.partitionBy(partition)
    w = w.bucketBy(buckets, BUCKET_KEY)
    if sort:
        w = w.sortBy(BUCKET_KEY)
    table = _table_name(build, name)
    w.saveAsTable(table)
    return spark.table(table)


def _write_manifest(spark: SparkSession, path: str, build: str, locations: dict[str, str],
                    specs: dict[str, str]) -> None:
    """Row counts of every table, where it lives and how it is bucketed; written
    last, as one more version beside the earlier ones, which are never touched: a
    failed write leaves no visible file and the last complete version in force."""
    try:
        version = manifest_rows(spark, path)[0]["version"] + 1
    except AnalysisException:
        version = 1
    counted = {n: _open_table(spark, loc, n, None) for n, loc in locations.items()}  # footers
    loc_col = F.lit(None).cast("string")
    spec_col = F.lit(None).cast("string")
    for n, loc in locations.items():
        loc_col = F.when(F.col("source") == n, F.lit(loc)).otherwise(loc_col)
    for n, sp in specs.items():
        spec_col = F.when(F.col("source") == n, F.lit(sp)).otherwise(spec_col)
    (load_metrics(counted).withColumn("build", F.lit(build))
     .withColumn("location", loc_col).withColumn("bucket_spec", spec_col)
     .withColumn("version", F.lit(version).cast("bigint"))
     .coalesce(1).write.mode("append").parquet(f"{path}/manifest"))


def manifest_rows(spark: SparkSession, path: str) -> list[Row]:
    """The current version of a warehouse's manifest, one row per table (of two
    writers of one version, one build's rows only)."""
    m = spark.read.parquet(f"{path}/manifest")
    newest = m.agg(F.max(F.struct("version", "build")).alias("n")).select("n.*")
    return m.join(F.broadcast(newest), ["version", "build"]).collect()


def write_fact(totals: DataFrame, year: DataFrame, n_time: int, write: Callable[[DataFrame], object],
               write_overflow: Callable[[DataFrame], object]) -> None:
    """Write the totals that fit as the fact, with their year, and the others as
    ``fact_overflow``; these are computed only if the first write met any, or returns
    False for no rows at all (an empty plan may be written without its counts)."""
    met = Observation()
    seen = totals.observe(met, F.count_if(overflows()).alias("n"))
    some = write(join_dim(fitting(seen), year, "timeID", "left", n_time))
    over = overflowed_keys(totals)
    write_overflow(over if some is False or met.get["n"] else totals.sparkSession.createDataFrame([], over.schema))


def put_fact(spark: SparkSession, build: str, totals: DataFrame, year: DataFrame, n_time: int, n: int,
             kept: dict[tuple, tuple] | None = None) -> None:
    """Write totals as the fact and ``fact_overflow`` of ``build``, partitioned by year and
    hash bucket, and ``fact_parts``: for each (year, bucket) its folder and the number of builds
    that wrote it, with those in ``kept`` (read from an earlier build, minus what is rewritten).
    The rows are rebalanced, so a bucket is few files and a big one is split over tasks."""
    written = []

    def write(fact: DataFrame) -> bool:
        parts = (PART_YEAR, PART_BUCKET)
        fact = fact.withColumn(PART_BUCKET, key_bucket(n)).hint("rebalance", *parts)
        back = _put(spark, build, fact, "fact", *parts)
        written.extend(tuple(r) for r in back.select(*parts).distinct().collect())   # years x n at most
        return bool(written)

    write_fact(totals, year, n_time, write, lambda df: _put(spark, build, df, "fact_overflow"))
    kept = kept or {}
    before = {p: v for p, (folder, v) in kept.items()}
    rows = [(*p, folder, v, n) for p, (folder, v) in kept.items() if folder is not None and p not in set(written)]
    rows += [(*p, build, before.get(p, 0) + 1, n) for p in written]
    (spark.createDataFrame(rows, f"{PART_YEAR} int, {PART_BUCKET} int, location string, version int, buckets int")
     .coalesce(1).write.mode("overwrite").parquet(f"{build}/fact_parts"))


def write_warehouse_from(spark: SparkSession, staging_in: DataFrame, customers_in: DataFrame,
                         transactions: DataFrame, path: str,
                         extra: dict[str, DataFrame] | None = None) -> None:
    """Load a warehouse into ``path`` from its three inputs.

    ``staging_in``: the denormalised product rows; ``customers_in``: the
    customer rows; ``transactions``: typed or parsed transactions (see
    :func:`~salesloom.operators.enrich.enrich_transactions`; rows the parser
    rejected are kept in the ledger with their reason).

    Order: product staging; product/supplier/store/customer dimensions from
    the written staging, and the rows they leave out as ``<dim>_rejects``
    (with an ``extra`` table of that name); product master and customer keys; every
    transaction enriched once into ``ledger`` (accepted rows and rejects
    together); then time dimension, fact and rejects from the written
    ledger.  Each step reads what the previous one wrote, so nothing is
    computed twice and a failed step reruns from the last written table.

    Every build writes into a fresh ``build-<id>`` folder and a version of the
    manifest (``path/manifest``, row counts + build folder) is added last: readers
    follow its newest version, so a build that dies halfway leaves the previous
    complete warehouse in place, and a readable version always names a
    complete build.  Keys whose total does not fit go to ``fact_overflow``.
    """
    build = _new_build(path)
    buckets = _bucket_count(spark)

    def put(df: DataFrame, name: str) -> DataFrame:
        return _put(spark, build, df, name)

    def put_bucketed(df: DataFrame, name: str, partition: str | None = None,
                     sort: bool = False) -> DataFrame:
        return _put_bucketed(spark, build, df, name, buckets, partition, sort)

    staging = put(staging_in, "staging")
    dims = {"product": put_bucketed(dim_product(staging), "product", sort=True),
            "supplier": put(dim_supplier(staging), "supplier"),
            "store": put(dim_store(staging), "store"),
            "customer": put(one_per_key(customers_in, "customerID"), "customer")}
    extra = dict(extra or {})
    for n, dim in dims.items():
        read = dim_candidates(staging, n) if n in DIM_COLUMNS else customers_in
        left_out, name = dim_rejects(read, dim, f"{n}ID"), f"{n}_rejects"
        put(extra.pop(name).unionByName(left_out, allowMissingColumns=True) if name in extra else left_out, name)
    rows = {n: d.count() for n, d in dims.items()}   # Parquet footers: a cheap count
    master = put(product_master(staging, dims["supplier"], dims["store"], rows), "product_master")
    ckeys = put(customer_keys(dims["customer"]), "customer_keys")
    ledger = put(enrich_with_masters(transactions, master, ckeys, rows), "ledger")
    time = put(dim_time(time_input(ledger)), "time")
    year = time.select("timeID", F.col("Year").alias(PART_YEAR))
    totals = fact_totals(accepted_facts(ledger), tasks=tasks_for(spark, ledger.count()))   # footers
    if buckets:
        write_fact(totals, year, time.count(), lambda df: put_bucketed(df, "fact", partition=PART_YEAR),
                   lambda df: put(df, "fact_overflow"))
    else:
        put_fact(spark, build, totals, year, time.count(), new_hash_buckets(spark))
    put(fact_rejects(ledger), "fact_rejects")
    for name, df in extra.items():
        put(df, name)
    names = ("fact", "time", "product", "supplier", "store", "customer", "staging",
             "fact_rejects", "fact_overflow", "product_master", "customer_keys", *DIM_REJECTS, *extra)
    _write_manifest(spark, path, build, {n: build for n in names},
                    {n: f"{BUCKET_KEY}:{buckets}" for n in BUCKETED} if buckets else {})


def write_warehouse(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Load the warehouse from the provided tables (see ``sources.tables``)."""
    write_warehouse_from(spark, product_staging_from_tables(spark, sf_dir),
                         customers_from_tables(spark, sf_dir),
                         _typed_transactions(spark, sf_dir), path)


def load_files_warehouse(spark: SparkSession, customers_csv: str, products_csv: str,
                         transactions_path: str, path: str) -> Star:
    """The file-based load: seed CSVs for customers and products, and a
    transaction text file (or folder).  CSV rows that do not type are kept
    in ``customer_rejects`` / ``product_rejects``, beside the rows that the
    dimensions leave out; transaction lines that do
    not parse or match are in ``fact_rejects`` with their reason."""
    customers = land(read_customers(spark, customers_csv), f"{path}/landing/customers")
    products = land(read_products(spark, products_csv), f"{path}/landing/products")
    parsed = parse_transactions(read_transaction_lines(spark, transactions_path))
    write_warehouse_from(spark, accepted(products), accepted(customers), parsed, path,
                         extra={"customer_rejects": csv_rejects(customers),
                                "product_rejects": csv_rejects(products)})
    return read_star(spark, path)


def append_transactions(spark: SparkSession, path: str, transactions: DataFrame) -> Star:
    """Add transactions to a written warehouse: another run of the loader.

    The new rows are enriched against the warehouse's current masters (with
    quarantine); the time dimension gains the timeIDs it did not have
    (insert-if-absent: stored rows win); the fact becomes the additive
    collapse of the stored fact and the new rows, where stored rows count as
    arriving first, so they keep their first-arrival columns.  The fact,
    time dimension and rejects are written to a new build; the dimensions
    and masters stay where they are, and the new manifest points to both.

    Plain Parquet has no MERGE, so parts of the fact are rewritten, but only those
    (year, hash bucket) parts that change: the new rows' buckets are found first (at most
    the number of buckets), the keys stored in them are matched with the new keys (a
    semi join, with the new keys broadcast when their count is within the bound), and
    only the parts of matched keys and those that new keys fall in are read whole and
    written anew.  The other parts stay in their folders, unread; ``fact_parts`` in
    the new build lists where each lives.  With the opt-in productID layout the
    whole fact is rewritten.
    """
    rows, _ = read_manifest(spark, path)
    locs = table_locations(spark, path)
    t = _tables(spark, path)
    build = _new_build(path)
    buckets = _bucket_count(spark)
    ledger = _put(spark, build, enrich_with_masters(transactions, t["product_master"],
                                                    t["customer_keys"], rows), "ledger")
    time = _put(spark, build, merge_time_dim(t["time"], dim_time(time_input(ledger))), "time")
    kind = ledger.schema["arrival"].dataType
    new = (accepted_facts(ledger)
           .withColumn("arrival", F.struct(F.lit(1).alias("load"), F.col("arrival").alias("a"))))
    year = time.select("timeID", F.col("Year").alias(PART_YEAR))
    n_time = time.count()
    old_fact = t["fact"]
    manifest = manifest_rows(spark, path)
    old_spec = {r["source"]: r["bucket_spec"] for r in manifest}.get("fact")
    # totals kept out of the fact so far, with wide amounts: new rows add to them as well
    first = F.struct(F.lit(0).alias("load"), F.lit(None).cast(kind).alias("a"))
    over = t["fact_overflow"].drop("reject_reason").withColumn("arrival", first)
    parts = None if buckets or old_spec else _fact_parts(spark, locs["fact"])
    if parts is None:
        stored = old_fact.drop(PART_YEAR, PART_BUCKET).withColumn("arrival", first)
    else:
        touched = _touched_parts(spark, build, parts, old_fact.schema, new, over, year, n_time)
        old_fact = _open_parts(spark, {p: parts[p] for p in touched if p in parts}, old_fact.schema)
        stored = old_fact.drop(PART_YEAR, PART_BUCKET).withColumn("arrival", first)
    totals = fact_totals(over.unionByName(stored.select(*over.columns)).unionByName(new.select(*over.columns)))
    if parts is None and buckets:
        write_fact(totals, year, n_time, lambda df: _put_bucketed(spark, build, df, "fact", buckets, PART_YEAR),
                   lambda df: _put(spark, build, df, "fact_overflow"))
    else:
        # a part that is rewritten keeps its version and gets its folder when it is written
        kept = {p: (None if p in touched else r["location"], r["version"])
                for p, r in (parts or {}).items()}
        n = next((r["buckets"] for r in (parts or {}).values()), None) or new_hash_buckets(spark)
        put_fact(spark, build, totals, year, n_time, n, kept)
    rejects = t["fact_rejects"].unionByName(fact_rejects(ledger), allowMissingColumns=True)
    _put(spark, build, rejects, "fact_rejects")
    locs.update({"fact": build, "time": build, "fact_rejects": build, "fact_overflow": build})
    specs = {r["source"]: r["bucket_spec"] for r in manifest if r["bucket_spec"]}
    specs.pop("fact", None)
    if buckets:
        specs["fact"] = f"{BUCKET_KEY}:{buckets}"
    _write_manifest(spark, path, build, locs, specs)
    return read_star(spark, path)


def read_manifest(spark: SparkSession, path: str) -> tuple[dict[str, int], str]:
    """Row counts per table and the build folder of a written warehouse."""
    rows = manifest_rows(spark, path)
    return {r["source"]: int(r["rows"]) for r in rows}, rows[0]["build"]


def table_locations(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every table of a written warehouse (its build, or the older
    build a table was carried over from)."""
    return {r["source"]: r["location"] or r["build"] for r in manifest_rows(spark, path)}


def _table_name(build: str, name: str) -> str:
    return "salesloom_" + os.path.basename(build).replace("-", "_") + "_" + name


HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def _fact_parts(spark: SparkSession, loc: str) -> dict[tuple, Row] | None:
    """{(year, bucket): its row of ``fact_parts``} of a fact in hash buckets."""
    try:
        rows = spark.read.parquet(f"{loc}/fact_parts").collect()   # at most years x buckets
    except AnalysisException:
        return None
    return {(r[PART_YEAR], r[PART_BUCKET]): r for r in rows}


def _part_folder(part: tuple) -> str:
    year, bucket = (HIVE_NULL if v is None else v for v in part)
    return f"{PART_YEAR}={year}/{PART_BUCKET}={bucket}"


def _open_parts(spark: SparkSession, parts: dict[tuple, Row], schema: StructType | None = None) -> DataFrame:
    """The given parts of a fact that may live in different builds: one scan per build over
    its parts in force, so filters on year and bucket prune them.  ``schema`` is needed for no parts."""
    folders: dict[str, list[str]] = {}
    for p, r in parts.items():
        folders.setdefault(r["location"], []).append(f"{r['location']}/fact/{_part_folder(p)}")
    if not folders:
        return spark.createDataFrame([], schema)
    if schema is None:
        data = spark.read.parquet(next(iter(folders.values()))[0]).schema
        schema = StructType([*data.fields, StructField(PART_YEAR, IntegerType()), StructField(PART_BUCKET, IntegerType())])
    scans = [spark.read.schema(schema).option("basePath", f"{folder}/fact").parquet(*sorted(paths))
             for folder, paths in sorted(folders.items())]
    return reduce(DataFrame.unionByName, scans)


def _touched_parts(spark: SparkSession, build: str, parts: dict[tuple, Row], schema: StructType,
                   new: DataFrame, over: DataFrame, year: DataFrame, n_time: int) -> set[tuple]:
    """The parts that rows ``new`` change; stored parts of other buckets are not read."""
    if not parts:
        return set()
    n = next(iter(parts.values()))["buckets"]
    pair = (PART_YEAR, PART_BUCKET)
    keys = new.select(*FACT_KEY).distinct()
    seen = keys.groupBy(key_bucket(n).alias("b")).count().collect()                # at most n rows
    n_keys, hit_buckets = sum(r["count"] for r in seen), {r["b"] for r in seen}
    stored = _open_parts(spark, {p: r for p, r in parts.items() if p[1] in hit_buckets}, schema)
    hit = _put(spark, build, join_dim(stored.select(*FACT_KEY, *pair), keys, FACT_KEY, "left_semi", n_keys),
               "matched_keys")
    rows = join_dim(over, keys, FACT_KEY, "left_semi", n_keys).unionByName(new.select(*over.columns))
    fresh = (join_dim(fact_totals(rows), year, "timeID", "left", n_time)
             .join(hit.select(*FACT_KEY), FACT_KEY, "left_anti").withColumn(PART_BUCKET, key_bucket(n)))
    touched = {tuple(r) for r in hit.select(*pair).unionByName(fresh.select(*pair)).distinct().collect()}
    unknown = {p: parts[p] for p in touched if p[0] is None and p in parts}
    if unknown:      # their rows' time may be known by now: they move to its year
        moved = join_dim(_open_parts(spark, unknown, schema).drop(PART_YEAR), year, "timeID", "left", n_time)
        touched |= {tuple(r) for r in moved.select(*pair).distinct().collect()}
    return touched


def _open_table(spark: SparkSession, loc: str, name: str, spec: str | None) -> DataFrame:
    """A written table; bucketed ones are read through the session catalog
    (re-registered over their folder in a new session) so that Spark knows
    their bucketing, the rest by path."""
    if name == "fact" and not spec:
        parts = _fact_parts(spark, loc)
        if parts:
            return _open_parts(spark, parts)
    if not spec:
        return spark.read.parquet(f"{loc}/{name}")
    table = _table_name(loc, name)
    try:
        if not spark.catalog.tableExists(table):
            key, n = spec.split(":")
            schema = spark.read.parquet(f"{loc}/{name}").schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            part = f"PARTITIONED BY ({PART_YEAR})" if PART_YEAR in schema.fieldNames() else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet {part} "
                      f"CLUSTERED BY ({key}) INTO {n} BUCKETS LOCATION '{loc}/{name}'")
            if part:
                spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return spark.table(table)
    except AnalysisException:
        # a catalog that cannot register it: same rows by path, without bucketing
        return spark.read.parquet(f"{loc}/{name}")


def _tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Every table of a written warehouse.  A table lives in the build folder
    unless the manifest names another location (a star that reuses another
    warehouse's dimensions)."""
    return {r["source"]: _open_table(spark, r["location"] or r["build"], r["source"], r["bucket_spec"])
            for r in manifest_rows(spark, path)}


def read_dims(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The dimension tables of a written warehouse, with the columns the
    loader looks up (customer 3, product 3, supplier 2, store 2, staging 7)."""
    locs = table_locations(spark, path)
    cols = {"customer": ["customerID", "customerName", "gender"],
            "product": ["productID", "productName", "productPrice"],
            "supplier": ["supplierID", "supplierName"], "store": ["storeID", "storeName"],
            "staging": ["productID", "productName", "productPrice", "supplierID", "supplierName",
                        "storeID", "storeName"]}
    return {n: spark.read.parquet(f"{locs[n]}/{n}").select(*c) for n, c in cols.items()}


def read_star(spark: SparkSession, path: str) -> Star:
    """A :class:`Star` over a written warehouse (raises if incomplete)."""
    rows, _ = read_manifest(spark, path)
    t = _tables(spark, path)
    return Star(fact=t["fact"], time=t["time"], product=t["product"], supplier=t["supplier"],
                store=t["store"], customer=t["customer"], staging=t.get("staging"), rows=rows,
                extra={n: t[n] for n in rows if n not in ("fact", *DIMS, *LOOKUPS)})


_cache: dict[tuple[str, str], tuple[int, Star]] = {}


def load_warehouse(spark: SparkSession, sf_dir: str, path: str | None = None,
                   rebuild: bool = False) -> Star:
    """Build and write the warehouse for ``sf_dir`` once; reuse it after, as its
    newest manifest version describes it."""
    path = path or warehouse_path(spark, sf_dir)
    key = (spark.sparkContext.applicationId, path)

    def version() -> int | None:
        try:
            return manifest_rows(spark, path)[0]["version"]
        except AnalysisException:
            return None

    now = None if rebuild else version()
    if now is None:
        write_warehouse(spark, sf_dir, path)
        now = version()
    if _cache.get(key, (None,))[0] != now:
        _cache[key] = (now, read_star(spark, path))
    return _cache[key][1]
