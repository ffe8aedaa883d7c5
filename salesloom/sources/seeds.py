"""Seed CSV scans for the customer and the denormalised product files.

Both files: comma separated, fields may be enclosed in double quotes (so a
quoted comma survives), one header line.  Rows that do not fit the schema
are kept in ``_corrupt_record`` and can be routed to a quarantine with
:func:`csv_rejects` instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.schemas import CUSTOMER_CSV, PRODUCT_CSV

CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(with_corrupt)
            .option("header", "true").option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """customerID, customerName, gender (+ ``_corrupt_record``)."""
    return _read(spark, path, CUSTOMER_CSV)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """The 7-column product staging file (+ ``_corrupt_record``)."""
    return _read(spark, path, PRODUCT_CSV)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write a typed CSV scan (with its corrupt-record column) to Parquet and
    read it back.  Spark refuses plans over a raw CSV scan that only need
    the corrupt-record column (e.g. counting rejects), so both the accepted
    and the rejected side are taken from the landed copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def csv_rejects(df: DataFrame) -> DataFrame:
    """Rows the CSV reader could not type: raw text, reason, and the fields
    that did parse.  Use on a :func:`land`-ed scan."""
    fields = [c for c in df.columns if c != CORRUPT]
    return (df.where(F.col(CORRUPT).isNotNull())
            .select(F.col(CORRUPT).alias("raw"), F.lit("bad_csv_row").alias("reject_reason"),
                    *fields))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
