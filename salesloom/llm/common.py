"""Helpers shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import shared_dir

CHUNK_BYTES = 4 << 20     # text worked on at once inside a task
#: Spark's setting that removes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared checkpoint folder and read back, so
    that lost executors never make later steps recompute it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, read back: for wide data of
    which later steps read few columns.  The table stays there until ``forget`` is given it;
    the shuffle files that led to it go when it is complete, not when the driver's garbage is collected."""
    path = f"{shared_dir(df.sparkSession)}/llm/{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def forget(*tables: DataFrame) -> None:
    """Removes what ``written`` wrote for ``tables``, once all that was made from them is
    written itself."""
    for table in tables:
        path = table.__dict__.pop("_folder", None)
        if path:
            spark = table.sparkSession
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null id: crc32 of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` holding about ``limit`` bytes of ``column`` each (one
    row at least, so a single longer text is a slice of its own)."""
    import pyarrow.compute as pc

    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes.astype(np.int64)) - sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, n], strict=True):
        yield batch.slice(int(a), int(b - a))


def map_chunks(df: DataFrame, column: str, schema: str,
               start: Callable[[], Callable[[pa.RecordBatch], dict[str, Any]]], limit: int = CHUNK_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of about ``limit`` bytes.  ``start`` runs once per task and returns
    the function that turns a slice into output columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    with_types = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in chunks(batch, column, limit):
                out = work(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array)
                     else out[f.name].cast(f.type) for f in with_types], schema=with_types)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as strings, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def hash_bytes(values: list[bytes]) -> np.ndarray:
    """64-bit hashes (xxhash) of byte strings."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v) for v in values), dtype=np.uint64, count=len(values))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit integers (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
