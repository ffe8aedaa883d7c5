"""JDBC tables as sources and sinks (for a warehouse kept in a database).

Not exercised by the tests: this environment has no database server.

* :func:`read_jdbc_table` reads only the named columns and, given a numeric
  ``partition_column`` with bounds, splits the read into
  ``num_partitions`` parallel range queries instead of one connection.
* :func:`write_jdbc_table` writes whole partitions with batched inserts
  (``batchsize``), one connection per task, never one statement per row
  from the driver.  JDBC has no upsert: write a collapsed fact (see
  :func:`~salesloom.operators.fact.collapse_fact`) with ``mode="overwrite"``,
  or append ledger rows and collapse when reading.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, url: str, table: str, columns: Sequence[str],
                    properties: Mapping[str, str] | None = None,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    query = f"(SELECT {', '.join(columns)} FROM {table}) AS t"
    r = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism)))
    return r.load()


def write_jdbc_table(df: DataFrame, url: str, table: str,
                     properties: Mapping[str, str] | None = None, mode: str = "append",
                     batch_size: int = 10_000) -> None:
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
