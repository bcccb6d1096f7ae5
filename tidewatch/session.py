"""Session helpers: UTC, ANSI, AQE; reliable checkpoints in the shared folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on.  Time maths is done in UTC,
# ANSI mode stays on (so coercion is explicit via try_* functions), and AQE
# re-plans joins / coalesces partitions / splits skewed partitions at runtime.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python-side call-site capture for error context costs a stack walk and
    # JVM round trips per Column call; plans here build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidewatch", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "8g")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("FATAL")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is honoured as is.  Only a local test session without one gets a
    fresh scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="tidewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def stage_checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage between pipeline stages with a table in the shared folder.

    The stage is written once as Parquet under ``spark.checkpoint.dir`` and
    read back, so downstream plans start from a pruned columnar scan and a
    lost executor re-reads the files instead of recomputing the upstream
    plan.  (``DataFrame.checkpoint(eager=True)`` would compute the plan twice:
    once to count, once to write.)
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "stages", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def discard_stage(df: DataFrame, *stages: DataFrame) -> DataFrame:
    """``df``, after the files of stages that it no longer reads have been deleted."""
    spark = df.sparkSession
    for stage in stages:
        path = spark._jvm.org.apache.hadoop.fs.Path(stage._stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return df
