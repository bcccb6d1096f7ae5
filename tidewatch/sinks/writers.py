"""Sinks (K-01 .. K-04): tables, GeoJSON features, full-refresh publish.

All writers are distributed: each task writes its own part files.  GeoJSON
is written as one Feature per line (GeoJSON text sequences), so no single
task or driver ever assembles a whole FeatureCollection.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """K-01: Parquet (default) or CSV with header, optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def geojson_features(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                     keep_nulls: bool = True, ts_format: str = "yyyy-MM-dd'T'HH:mm:ss'Z'") -> DataFrame:
    """K-02: one GeoJSON Feature (string column ``feature``) per row.

    Rows without both coordinates (null or not a number) are dropped;
    timestamps become ISO text; NaN and infinite values become null;
    every other column goes to ``properties`` (missing -> null unless
    ``keep_nulls`` is False, which drops null attributes as the publish step does).
    """
    props = []
    for f in df.schema.fields:
        if f.name in (lat, lon):
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, ts_format)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):  # JSON has no NaN or infinity
            c = F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)
        props.append(c.alias(f.name))
    geom = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
    feat = F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"), F.struct(*props).alias("properties"))
    opts = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return (df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))
              .select(F.to_json(feat, opts).alias("feature")))


def write_geojson(df: DataFrame, path: str, **kw) -> None:
    geojson_features(df, **kw).write.mode("overwrite").text(path)


def publish_projection(df: DataFrame, rename: dict[str, str] | None = None, numeric: list[str] | None = None,
                       dates: dict[str, str] | None = None) -> DataFrame:
    """K-04: rename, cast numerics to double, format dates as text."""
    out = df
    if rename:
        out = out.withColumnsRenamed(rename)
    for c in numeric or []:
        out = out.withColumn(c, F.col(c).try_cast("double"))
    for c, fmt in (dates or {}).items():
        out = out.withColumn(c, F.date_format(F.col(c), fmt))
    return out


def publish_full_refresh(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """K-03: truncate-and-load a published table; the old one stays if the load fails.

    The rows are written beside the target and counted while they are written
    (the plan runs once); the copy is read back and counted, and only when both
    agree does it take the target's place.  Returns the number of rows.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]
    new, old = f"{path}.new-{run}", f"{path}.old-{run}"
    seen = Observation(f"publish_{run}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).save(new)
    written, expected = spark.read.schema(df.schema).format(fmt).load(new).count(), seen.get["n"]
    target, beside, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if written != expected:
        fs.delete(beside, True)
        raise RuntimeError(f"published {written} rows, expected {expected}; {path} is unchanged")
    had = fs.exists(target)
    if had:
        fs.rename(target, aside)
    if not fs.rename(beside, target):
        if had:
            fs.rename(aside, target)
        raise RuntimeError(f"could not replace {path}")
    if had:
        fs.delete(aside, True)
    return written
