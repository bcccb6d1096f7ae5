"""Landed JSON feeds: documents in files, read by glob or as a stream, broken ones set aside (S-01 .. S-09, ST-01).

A feed lands as one document per file, often over many lines; pages are more files.
Readers take the feed's explicit schema and keep every file: one that does not parse
becomes a reject with its path and text, never a row of nulls.  A parsed table is
written once, since rows and rejects both come from it.

Files are listed by a few tasks per core.  Spark starts a task for every path
otherwise, up to 10,000 in each listing, and starting them takes longer than
listing; a stream lists three times.
"""
from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import stage_checkpoint
from tidewatch.sources import envelopes as env

CORRUPT = "_corrupt"
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4  # per core
#: Feed -> (schema of a document, rows of parsed documents).
FEEDS = {
    "catalog": (env.CATALOG_SCHEMA, env.flatten_catalog),
    "station_meta": (env.META_SCHEMA, env.flatten_station_meta),
    "observations": (env.OBS_SCHEMA, lambda d: env.split_observations(d)[0]),
    "alerts": (env.ALERTS_SCHEMA, env.flatten_alerts),
    "zones": (env.ZONES_SCHEMA, env.flatten_zones),
    "forecast": (env.FORECAST_SCHEMA, env.flatten_forecast),
    "quakes": (env.QUAKE_SCHEMA, env.flatten_quakes),
    "water": (env.WATER_SCHEMA, env.flatten_water),
}


def land(docs: DataFrame, folder: str) -> None:
    """Write documents (``page``, ``payload``) as files ``<folder>/page=<page>/...``, one document each."""
    docs.select(F.col("page").cast("string").alias("page"), "payload").repartition("page").write.partitionBy("page").text(folder)


def _schema(feed: str) -> T.StructType:
    return T.StructType([*FEEDS[feed][0].fields, T.StructField(CORRUPT, T.StringType())])


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Limit the tasks of a listing, a lower setting of the session's kept."""
    old = spark.conf.get(LISTING_CONF)
    spark.conf.set(LISTING_CONF, str(min(int(old), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_CONF, old)


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file"))


def split(parsed: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the feed, rejects with file and text) of a parsed table that has been written."""
    return (FEEDS[feed][1](parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file")),
            parsed.filter(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("payload")))


def read_feed(spark: SparkSession, feed: str, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files under a path, a glob or a list of them."""
    with _few_listing_tasks(spark):
        d = spark.read.schema(_schema(feed)).options(multiLine=True, columnNameOfCorruptRecord=CORRUPT).json(path)
        return split(stage_checkpoint(_with_file(d), f"feed_{feed}"), feed)


def stream_feed(spark: SparkSession, feed: str, path: str, state_dir: str, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ST-01: the same by a file stream over a folder or glob, run to the end of what has landed.

    Documents are stored as they are parsed, one output partition per batch; started
    again with the same ``state_dir`` it reads the files that have come since.
    """
    from tidewatch.streaming.streams import BATCH_BYTES, run_to_end, write_batch
    limit = ("maxBytesPerTrigger", BATCH_BYTES) if max_files is None else ("maxFilesPerTrigger", max_files)
    out = os.path.join(state_dir, "documents")
    with _few_listing_tasks(spark):
        s = spark.readStream.schema(_schema(feed)).options(multiLine=True, columnNameOfCorruptRecord=CORRUPT).option(*limit).json(path)
        run_to_end(_with_file(s), os.path.join(state_dir, "checkpoint"), lambda batch, n: write_batch(batch, n, out))
    schema = T.StructType([*_schema(feed).fields, T.StructField("file", T.StringType())])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):  # nothing has landed
        return split(spark.createDataFrame([], schema), feed)
    return split(spark.read.schema(schema).parquet(out), feed)


def read_header_tables(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """S-09 by file: (rows, rejects) of array-of-arrays files whose first row names the columns."""
    with _few_listing_tasks(spark):
        d = spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file"))
        d = stage_checkpoint(d, "feed_header_tables")
    ok = F.coalesce(F.size(F.from_json("payload", "array<array<string>>")) > 0, F.lit(False))
    return env.header_table(d.filter(ok), "payload", columns), d.filter(~ok).select("file", "payload")
