"""Session construction and shared-folder helpers.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; this
module never invents one there.  Only a ``local[...]`` master (tests, the
bench) gets a private scratch folder when the setting is absent.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_scratch: dict[str, str] = {}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "salesloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         # local runs: let AQE keep small shuffles spread over the cores
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for written tables and stream checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (or the checkpoint dir
    set on its SparkContext).  When neither is set and
    the master is local, a private folder is created once per application
    and registered as the checkpoint dir; on a cluster an unset value is an
    error, because a machine-local folder would not survive executor loss.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _local_scratch:
        return _local_scratch[app]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="salesloom-")
    spark.sparkContext.setCheckpointDir(d)
    _local_scratch[app] = d
    return d


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written below the shared folder and read back: several jobs read it, and a
    lost executor never makes them repeat what led to it."""
    path = f"{shared_dir(df.sparkSession)}/work/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
