"""Schemas of the JSON feeds (S-01 .. S-09) and the rows of their documents.

Documents come from files (``sources.landing``: one per file, pages are more
files) or as a string column (``_parse``); either way the same functions make
rows of them.

No schema inference, no ``mergeSchema``; coercion is ``try_cast`` so a bad
value becomes null instead of failing the job.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.timefn import epoch_ms_to_ts, parse_ts

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


CATALOG_SCHEMA = _st(("stations", T.ArrayType(_st(
    ("id", S), ("name", S), ("state", S), ("lat", D), ("lng", D), ("shefcode", S), ("tidal", B)))))

META_SCHEMA = _st(("stations", T.ArrayType(_st(
    ("id", S), ("name", S), ("shefcode", S), ("lat", D), ("lng", D),
    ("floodlevels", _st(("nos_minor", D), ("action", D), ("nos_moderate", D), ("nos_major", D)))))))

OBS_SCHEMA = _st(("station_id", S), ("error", _st(("message", S))),
                 ("data", T.ArrayType(_st(("t", S), ("v", S), ("s", S), ("f", S), ("q", S)))))

ALERT_PROPS = _st(("id", S), ("event", S), ("severity", S), ("urgency", S), ("certainty", S), ("headline", S),
                  ("description", S), ("instruction", S), ("response", S), ("senderName", S), ("sent", S),
                  ("onset", S), ("ends", S), ("expires", S), ("status", S), ("areaDesc", S),
                  ("affectedZones", T.ArrayType(S)), ("geocode", _st(("UGC", T.ArrayType(S)))))
ALERTS_SCHEMA = _st(("features", T.ArrayType(_st(("id", S), ("properties", ALERT_PROPS)))))

ZONES_SCHEMA = _st(("features", T.ArrayType(_st(
    ("properties", _st(("id", S), ("name", S), ("state", S))),
    ("geometry", _st(("type", S), ("coordinates", S)))))))

FORECAST_SCHEMA = _st(("properties", _st(("periods", T.ArrayType(_st(
    ("name", S), ("startTime", S), ("temperature", I), ("temperatureUnit", S), ("windSpeed", S),
    ("windDirection", S), ("shortForecast", S), ("detailedForecast", S)))))))

QUAKE_SCHEMA = _st(("features", T.ArrayType(_st(
    ("id", S),
    ("properties", _st(("time", L), ("updated", L), ("mag", D), ("place", S), ("status", S), ("alert", S),
                       ("tsunami", I))),
    ("geometry", _st(("coordinates", T.ArrayType(D))))))))

WATER_SCHEMA = _st(("features", T.ArrayType(_st(
    ("properties", _st(("timeseries_id", S), ("monitoring_location_id", S), ("value", S),
                       ("approval_status", S), ("last_modified", S), ("parameter_code", S),
                       ("statistic_id", S), ("unit_of_measure", S), ("time", S), ("qualifier", T.VariantType()))),
    ("geometry", _st(("type", S), ("coordinates", T.ArrayType(D))))))))


def _parse(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    return df.select(F.from_json(F.col(col), schema).alias("_doc")).select("_doc.*")


# ---------------- S-01 / S-02 -----------------

def flatten_catalog(doc: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Station rows of catalogue documents; ``keep`` carries document-level columns."""
    s = doc.select(*keep, F.explode("stations").alias("s"))
    return s.select(*keep, F.col("s.id").alias("id"), F.col("s.name").alias("name"), F.col("s.state").alias("state"),
                    F.col("s.lat").alias("lat"), F.col("s.lng").alias("lng"), F.col("s.shefcode").alias("shefcode"),
                    F.col("s.tidal").alias("tidal"))


def flatten_station_meta(doc: DataFrame) -> DataFrame:
    s = doc.select(F.explode("stations").alias("s"))
    fl = F.col("s.floodlevels")
    return s.select(F.col("s.id").alias("station_id"), F.col("s.name").alias("station_name"),
                    F.col("s.shefcode").alias("shefcode"), F.col("s.lat").alias("lat"), F.col("s.lng").alias("lon"),
                    fl["nos_minor"].alias("nos_minor"), fl["action"].alias("action"),
                    fl["nos_moderate"].alias("nos_moderate"), fl["nos_major"].alias("nos_major"))


# ---------------- S-03 observations with rejects -----------------

NO_DATA = "no data was found"


def split_observations(doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects).

    ``error`` absent -> explode ``data``; an error whose message says "No data
    was found" -> no rows and no reject; any other error -> the station goes
    to rejects (it is skipped, as in the feed client).
    """
    err = F.col("error.message")
    ok = doc.filter(err.isNull())
    rows = ok.select("station_id", F.explode("data").alias("d")).select(
        "station_id",
        parse_ts(F.col("d.t")).alias("time_utc"),
        F.col("d.v").try_cast("double").alias("water_level"),
        F.col("d.s").try_cast("double").alias("sigma"),
        F.col("d.f").alias("flags"),
        F.col("d.q").alias("quality"),
    ).filter(F.col("time_utc").isNotNull())
    rejects = doc.filter(err.isNotNull() & ~F.lower(err).contains(NO_DATA)).select(
        "station_id", err.alias("error_message"))
    return rows, rejects


# ---------------- S-04 / S-05 / S-06 -----------------

def flatten_alerts(doc: DataFrame) -> DataFrame:
    f = doc.select(F.explode("features").alias("f")).select("f.properties.*")
    return f.select(
        "id", "event", "severity", "urgency", "certainty", "headline", "description", "instruction", "response",
        F.col("senderName").alias("sender_name"), parse_ts("sent").alias("sent"), parse_ts("onset").alias("onset"),
        parse_ts("ends").alias("ends"), parse_ts("expires").alias("expires"), "status",
        F.col("areaDesc").alias("area_desc"),
        F.coalesce(F.col("affectedZones"), F.array().cast("array<string>")).alias("affected_zones"),
        F.array_join(F.coalesce(F.col("geocode.UGC"), F.array().cast("array<string>")), ",").alias("ugc_list"),
    )


def flatten_zones(doc: DataFrame) -> DataFrame:
    """S-05: zone reference rows with the first ring of a Polygon, or of a MultiPolygon's first part;
    features without id or name are left out, missing or other geometry has no ring."""
    f = doc.select(F.explode("features").alias("f"))
    kind, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polygon = F.from_json(coords, "array<array<array<double>>>")
    parts = F.get(F.from_json(coords, "array<array<array<array<double>>>>"), F.lit(0))
    z = f.select(F.col("f.properties.id").alias("zone_id"), F.col("f.properties.name").alias("zone_name"),
                 F.col("f.properties.state").alias("state"), kind.alias("geometry_type"),
                 F.when(kind == "MultiPolygon", parts).when(kind == "Polygon", polygon).alias("rings"))
    return z.filter((F.col("zone_id") != "") & (F.col("zone_name") != ""))


def flatten_forecast(doc: DataFrame) -> DataFrame:
    p = doc.select(F.explode("properties.periods").alias("p")).select("p.*")
    return p.select(
        F.col("name").alias("period_name"), parse_ts("startTime").alias("start_time"),
        F.concat_ws(" ", F.col("temperature").cast("string"), F.col("temperatureUnit")).alias("temp"),
        F.concat_ws(" ", F.col("windSpeed"), F.col("windDirection")).alias("wind"),
        F.col("shortForecast").alias("short_forecast"), F.col("detailedForecast").alias("detailed_forecast"))


# ---------------- S-07 earthquakes -----------------

def flatten_quakes(doc: DataFrame, run_utc=None) -> DataFrame:
    f = doc.select(F.explode("features").alias("f"))
    c = F.col("f.geometry.coordinates")
    out = f.select(
        F.col("f.id").alias("event_id"),
        epoch_ms_to_ts(F.col("f.properties.time")).alias("time_utc"),
        F.col("f.properties.mag").alias("magnitude"),
        F.get(c, 2).alias("depth_km"),
        F.get(c, 0).alias("longitude"),
        F.get(c, 1).alias("latitude"),
        F.col("f.properties.place").alias("place"),
        F.col("f.properties.status").alias("status"),
        F.col("f.properties.alert").alias("alert_level"),
        F.col("f.properties.tsunami").alias("tsunami"),
        epoch_ms_to_ts(F.col("f.properties.updated")).alias("updated_utc"),
    )
    return out if run_utc is None else out.withColumn("run_utc", run_utc)


# ---------------- S-08 multi-page daily values -----------------

def flatten_water(doc: DataFrame) -> DataFrame:
    f = doc.select(F.explode("features").alias("f"))
    q = F.col("f.properties.qualifier")
    from tidewatch.functions.arrays import list_or_scalar
    return f.select(
        F.coalesce(F.schema_of_variant(q).startswith("ARRAY"), F.lit(False)).alias("qualifier_is_list"),
        "f.properties.timeseries_id", "f.properties.monitoring_location_id",
        F.col("f.properties.value").try_cast("double").alias("value"),
        "f.properties.approval_status", parse_ts("f.properties.last_modified").alias("last_modified"),
        "f.properties.parameter_code", "f.properties.statistic_id", "f.properties.unit_of_measure",
        F.col("f.properties.time").alias("time"),
        list_or_scalar(q).alias("qualifier"),
        F.get(F.col("f.geometry.coordinates"), 0).alias("longitude"),
        F.get(F.col("f.geometry.coordinates"), 1).alias("latitude"),
    )


# ---------------- S-09 array-of-arrays with a header row -----------------

def header_table(df: DataFrame, col: str, columns: list[str]) -> DataFrame:
    """Rows of ``array<array<string>>`` payloads whose first row is the header ->
    one output row per data row, with the requested header names as columns."""
    arr = F.from_json(F.col(col), "array<array<string>>")
    d = df.select(arr.alias("_a")).select(F.col("_a")[0].alias("_h"), F.posexplode("_a").alias("_i", "_r"))
    d = d.filter(F.col("_i") > 0).select(F.map_from_arrays("_h", "_r").alias("_m"))
    return d.select(*[F.col("_m")[c].alias(c) for c in columns])


# ---------------- S-10 / S-11 tables -----------------

def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


#: Rows of a task that looks for repeated keys, and tasks that the rows of one key are spread over.
KEY_TASK_ROWS = 2_000_000
KEY_SALTS = 16


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """S-14: keys that occur more than once (the declared uniqueness contract).

    Nearly all keys are distinct, so combining the rows of an input split holds the
    whole split in memory and saves nothing.  Rows are dealt first, to as many
    tasks as their number asks for, and a key's rows to some of them, so that a
    frequent key is no task's alone; then the partial counts meet by key.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // KEY_TASK_ROWS))
    rows = df.select(*keys, F.pmod(F.monotonically_increasing_id(), F.lit(KEY_SALTS)).alias("_salt"))
    some = rows.repartition(parts, *keys, "_salt").groupBy(*keys, "_salt").count()
    return some.repartition(parts, *keys).groupBy(*keys).agg(F.sum("count").alias("count")).filter(F.col("count") > 1)
