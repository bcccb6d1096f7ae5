"""Registered queries: station metadata feed, station time series with provenance, text keys,
spec vulnerability, published and re-read tables, guarded stages, threshold bounds."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions import text as tx
from tidewatch.functions.timefn import ts_to_epoch_ms
from tidewatch.operators import catalog as cat
from tidewatch.operators import composite as CO
from tidewatch.plans import areas as A
from tidewatch.plans.oracle import _meta, sql
from tidewatch.plans.queries_spec import _clipq, _q
from tidewatch.plans.registry import out_sql, register
from tidewatch.session import ensure_checkpoint_dir
from tidewatch.sinks import writers as W
from tidewatch.sources import bind
from tidewatch.sources import envelopes as env


def _names(spec):
    return [c.split(":")[0].strip() for c in spec.split(",")]


def _folder(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "published", f"{name}-{uuid.uuid4().hex}")


# ---------------- S-02 station metadata with nested flood levels, joined to the series (F-17) -----------------

_MS = _meta("s_suppkey")
SERIES = ("station_id:l, obs_id:l, station_name, time_utc, water_level:d, flags, quality, lat:d, lon:d, minor:d, moderate:d, "
          "major:d, datum, units, run_utc")


def _meta_docs(spark, sf_dir):
    """One metadata document per supplier; every ninth has no flood levels."""
    s = bind.read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    m = bind.station_meta_columns(k)
    levels = F.when(k % 9 != 0, F.struct(m["nos_minor"].alias("nos_minor"), m["action"].alias("action"),
                                         m["nos_moderate"].alias("nos_moderate"), m["nos_major"].alias("nos_major")))
    entry = F.struct(k.cast("string").alias("id"), m["station_name"].alias("name"), m["shefcode"].alias("shefcode"),
                     m["lat"].alias("lat"), m["lon"].alias("lng"), levels.alias("floodlevels"))
    return s.select(F.to_json(F.struct(F.array(entry).alias("stations"))).alias("payload"))


@register("station_timeseries", sql(out_sql(SERIES, f"""(
    SELECT t.station_id, t.obs_id, m.station_name, t.time_utc, t.water_level, t.flags, t.quality, m.lat, m.lon,
      coalesce(CASE WHEN m.nos_minor <> 0 THEN m.nos_minor END, m.action) AS minor, m.nos_moderate AS moderate, m.nos_major AS major,
      'MLLW' AS datum, 'metric' AS units, strftime((SELECT as_of FROM as_of), '%Y-%m-%dT%H:%M:%S+00:00') AS run_utc
    FROM tidal_series t JOIN (
      SELECT s_suppkey AS station_id, {_MS['station_name']} AS station_name, {_MS['lat']} AS lat, {_MS['lon']} AS lon,
        CASE WHEN s_suppkey % 9 <> 0 THEN {_MS['nos_minor']} END AS nos_minor, CASE WHEN s_suppkey % 9 <> 0 THEN {_MS['action']} END AS action,
        CASE WHEN s_suppkey % 9 <> 0 THEN {_MS['nos_moderate']} END AS nos_moderate,
        CASE WHEN s_suppkey % 9 <> 0 THEN {_MS['nos_major']} END AS nos_major
      FROM supplier) m ON t.station_id = m.station_id)"""), "tidal_series", "as_of"))
def q_station_timeseries(spark, sf_dir):
    """S-02 metadata documents parsed and joined to the readings; F-17 datum, units and run time."""
    from tidewatch.operators.timeseries import minor_threshold
    from tidewatch.plans.stations import tidal_series
    meta = env.flatten_station_meta(env._parse(_meta_docs(spark, sf_dir), "payload", env.META_SCHEMA))
    meta = meta.select(F.col("station_id").cast("long").alias("station_id"), "station_name", "lat", "lon",
                       minor_threshold("nos_minor", "action").alias("minor"), F.col("nos_moderate").alias("moderate"),
                       F.col("nos_major").alias("major"))
    run = F.date_format(bind.series_as_of(spark, sf_dir), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    s = cat.assert_rows(tidal_series(spark, sf_dir), 1, what="station time series")  # F-15
    out = s.join(meta, "station_id").withColumns({"datum": F.lit(C.DATUM), "units": F.lit(C.UNITS), "run_utc": run})
    return out.select(*_names(SERIES))


# ---------------- T-02, T-03, T-05, D-DT5 -----------------

@register("text_keys", sql(out_sql("kind, source_text, key_text, epoch_ms:l", """(
    SELECT 'nation' AS kind, n_name || ' Municipio, Puerto Rico' AS source_text, n_name AS key_text, NULL::BIGINT AS epoch_ms FROM nation
    UNION ALL SELECT 'supplier', '  ' || s_name || ' Unit ', lower(s_name) || '_unit', NULL FROM supplier
    UNION ALL SELECT 'stations', ' ' || s_suppkey || ', ,' || (s_suppkey + 1) || ',', s_suppkey || '|' || (s_suppkey + 1), NULL FROM supplier
    UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR), o_orderstatus, epoch_ms(o_orderdate) FROM orders)""")))
def q_text_keys(spark, sf_dir):
    """T-03 suffixes off area names, T-02 simple keys, T-05 id lists, D-DT5 epoch milliseconds."""
    none = F.lit(None).cast("long").alias("epoch_ms")
    n, s, o = (bind.read_table(spark, sf_dir, t) for t in ("nation", "supplier", "orders"))
    area = F.concat(F.col("n_name"), F.lit(" Municipio, Puerto Rico"))
    unit = F.concat(F.lit("  "), F.col("s_name"), F.lit(" Unit "))
    k = F.col("s_suppkey")
    ids = F.concat(F.lit(" "), k.cast("string"), F.lit(", ,"), (k + 1).cast("string"), F.lit(","))
    return (n.select(F.lit("nation").alias("kind"), area.alias("source_text"),
                     tx.remove_suffixes(area, [", Puerto Rico", " Municipio"]).alias("key_text"), none)
            .unionByName(s.select(F.lit("supplier").alias("kind"), unit.alias("source_text"), tx.simple_key(unit).alias("key_text"), none))
            .unionByName(s.select(F.lit("stations").alias("kind"), ids.alias("source_text"),
                                  F.array_join(tx.split_list(ids), "|").alias("key_text"), none))
            .unionByName(o.select(F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("source_text"),
                                  F.col("o_orderstatus").alias("key_text"), ts_to_epoch_ms("o_orderdate").alias("epoch_ms"))))


# ---------------- SP-10 vulnerability by the spec -----------------

VULN = "area_id:l, access_constraints:d, access_score:d, housing_score:d, svi_score:d, vulnerability_spec:d"
_AW, _VW = C.SPEC_ACCESS_WEIGHTS, C.SPEC_VULNERABILITY_WEIGHTS


@register("spec_vulnerability", sql(out_sql(VULN, f"""(
    WITH v AS (SELECT c_nationkey AS area_id, avg((c_mktsegment = 'MACHINERY')::INT) * 100.0::DOUBLE AS nv,
        avg((c_mktsegment = 'BUILDING')::INT) * 100.0::DOUBLE AS sr, avg((c_acctbal < 0)::INT) * 100.0::DOUBLE AS hb,
        avg(c_acctbal) / 10000.0::DOUBLE AS svi FROM customer GROUP BY c_nationkey),
    a AS (SELECT *, {_AW['no_vehicle_pct']}::DOUBLE * nv + {_AW['single_route_fragility_pct']}::DOUBLE * sr AS access_constraints FROM v),
    s AS (SELECT *, {_clipq('access_constraints', _q('a', 'access_constraints', 0.05), _q('a', 'access_constraints', 0.95))} AS access_score,
        {_clipq('hb', _q('a', 'hb', 0.05), _q('a', 'hb', 0.95))} AS housing_score,
        least(greatest(svi, 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE AS svi_score FROM a)
    SELECT *, {_VW['svi_overall']}::DOUBLE * svi_score + {_VW['access_constraints']}::DOUBLE * access_score
      + {_VW['housing_fragility']}::DOUBLE * housing_score AS vulnerability_spec FROM s)""")))
def q_spec_vulnerability(spark, sf_dir):
    """SP-10 over area rates taken from the customers of each area."""
    rate = lambda c: F.avg(c.cast("double")) * 100.0
    c = bind.read_table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("area_id")).agg(
        rate(F.col("c_mktsegment") == "MACHINERY").alias("no_vehicle_pct"),
        rate(F.col("c_mktsegment") == "BUILDING").alias("single_route_fragility_pct"),
        rate(F.col("c_acctbal") < 0).alias("housing_burden_pct"), (F.avg("c_acctbal") / 10000.0).alias("svi_overall"))
    return CO.spec_vulnerability(c).select(*_names(VULN))


# ---------------- K-01, K-03, K-04, S-10 written and read back -----------------

TOWNS = "town, municipio, lat:d, lon:d"


@register("published_towns", sql(out_sql(TOWNS, """(
    SELECT designated_area AS town, municipio, latitude AS lat, longitude AS lon FROM towns)"""), "towns"))
def q_published_towns(spark, sf_dir):
    """K-04 projection -> K-01 CSV with header -> S-10 read with a schema -> K-03 full refresh (twice) -> read back."""
    t = bind.towns(spark, sf_dir).select("designated_area", "municipio", "latitude", "longitude")
    t = W.publish_projection(t, rename={"designated_area": "town", "latitude": "lat", "longitude": "lon"}, numeric=["lat", "lon"])
    csv, target = _folder(spark, "towns-csv"), _folder(spark, "towns")
    W.write_table(t, csv, fmt="csv")
    back = env.read_table_csv(spark, csv, t.schema)
    W.publish_full_refresh(back.limit(0), target)
    W.publish_full_refresh(back, target)
    return spark.read.schema(t.schema).parquet(target)


GEO = "area_id:l, municipio, priority_band, lat:d, lon:d, priority:d"


@register("geojson_areas", sql(out_sql(GEO, """(
    SELECT area_id, municipio, priority_band, latitude AS lat, longitude AS lon, priority_index_conf_adj AS priority
    FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL)"""), "scored"))
def q_geojson_areas(spark, sf_dir):
    """K-02 + R-05: scored areas as GeoJSON features, written as text and parsed back."""
    s = A.scored_indices(spark, sf_dir).select("area_id", "municipio", "latitude", "longitude", "priority_band", "priority_index_conf_adj")
    path = _folder(spark, "areas-geojson")
    W.write_geojson(s, path)
    f = spark.read.text(path).select(F.from_json("value", "geometry struct<coordinates: array<double>>, properties struct<"
                                                 "area_id: bigint, municipio: string, priority_band: string, priority_index_conf_adj: double>").alias("f"))
    p, xy = F.col("f.properties"), F.col("f.geometry.coordinates")
    return f.select(p["area_id"].alias("area_id"), p["municipio"].alias("municipio"), p["priority_band"].alias("priority_band"),
                    xy[1].alias("lat"), xy[0].alias("lon"), p["priority_index_conf_adj"].alias("priority"))


# ---------------- SP-07 bounds by thresholds first -----------------

@register("threshold_bounds", sql(out_sql("area_id:l, indicator, score:d", """(
    WITH v AS (SELECT c_nationkey AS area_id, avg(c_acctbal) AS value, CASE WHEN c_nationkey % 2 = 0 THEN 4000.0::DOUBLE END AS lo,
        CASE WHEN c_nationkey % 2 = 0 THEN 5000.0::DOUBLE END AS hi FROM customer GROUP BY c_nationkey),
    b AS (SELECT area_id, value, coalesce(lo, (SELECT quantile_cont(value, 0.05) FROM v)) AS lo,
        coalesce(hi, (SELECT quantile_cont(value, 0.95) FROM v)) AS hi FROM v)
    SELECT area_id, 'balance' AS indicator, CASE WHEN hi > lo
      THEN least(greatest((value - lo) / (hi - lo), 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE END AS score FROM b)""")))
def q_threshold_bounds(spark, sf_dir):
    """SP-07: rows that bring thresholds use them, the others the percentiles over all areas."""
    k = F.col("c_nationkey")
    v = bind.read_table(spark, sf_dir, "customer").groupBy(k.cast("long").alias("area_id")).agg(F.avg("c_acctbal").alias("value"))
    even = F.col("area_id") % 2 == 0
    long = v.withColumns({"indicator": F.lit("balance"), "thr_lo": F.when(even, F.lit(4000.0)), "thr_hi": F.when(even, F.lit(5000.0))})
    meta = CO.indicator_meta(spark, [("balance", "ics", 1.0, "higher_worse", "thresholds", 0.0, 100.0)])
    return CO.normalise_indicators(long, meta).select("area_id", "indicator", "score")


# ---------------- S-07, S-08, U-01, ST-01 landed files -----------------

PAGE_EVENTS = 500


def _landed_quakes(spark, sf_dir):
    """Folder of earthquake pages: events by their number, at most ``PAGE_EVENTS`` to a page, and one broken page per region."""
    from tidewatch.plans.queries_io import _quake_docs
    from tidewatch.sources import landing
    f = _quake_docs(spark, sf_dir).select(F.from_json("payload", "features array<string>")["features"][0].alias("f"))
    f = f.withColumn("page", F.floor(F.substring(F.get_json_object("f", "$.id"), 3, 30).cast("long") / PAGE_EVENTS).cast("string"))
    pages = f.groupBy("page").agg(F.concat(F.lit('{\n "features": [\n'), F.array_join(F.collect_list("f"), ",\n"), F.lit("\n ]\n}")).alias("payload"))
    broken = bind.read_table(spark, sf_dir, "region").select(
        F.concat(F.lit("broken-"), F.col("r_regionkey").cast("string")).alias("page"),
        F.concat(F.lit('{\n "features": [{"id": "'), F.col("r_name"), F.lit('", "proper')).alias("payload"))
    folder = _folder(spark, "quake-pages")
    landing.land(pages.unionByName(broken), folder)
    return folder


def _by_both_readers(spark, sf_dir, part):
    """Rows (part 0) or rejects (part 1) of the landed pages, by glob and by stream."""
    from tidewatch.sources import landing
    folder = _landed_quakes(spark, sf_dir)
    by_glob = landing.read_feed(spark, "quakes", f"{folder}/page=*")[part]
    by_stream = landing.stream_feed(spark, "quakes", f"{folder}/page=*", _folder(spark, "quake-stream"))[part]
    return by_glob.withColumn("reader", F.lit("glob")).unionByName(by_stream.withColumn("reader", F.lit("stream")))


LANDED = "reader, event_id, time_utc, magnitude:d, depth_km:d, longitude:d, latitude:d, place, status"


@register("landed_quakes", sql(out_sql(LANDED, """(
    SELECT r.reader, 'pr' || CAST(event_id AS VARCHAR) AS event_id, make_timestamp((epoch_us(time_utc) // 1000) * 1000) AS time_utc, magnitude,
      depth_km, longitude, latitude, place, status
    FROM quakes, (VALUES ('glob'), ('stream')) r(reader))"""), "quakes"))
def q_landed(spark, sf_dir):
    """S-07, U-01, ST-01: pages of earthquakes written as multi-line JSON files, read by glob and by a file stream."""
    d = _by_both_readers(spark, sf_dir, 0)
    return d.withColumn("time_utc", F.col("time_utc").cast("timestamp_ntz")).select(*[c.split(":")[0].strip() for c in LANDED.split(",")])


@register("landed_rejects", out_sql("reader, page, region, n_chars:l", """(
    SELECT r.reader, 'broken-' || CAST(r_regionkey AS VARCHAR) AS page, r_name AS region, 34 + length(r_name) AS n_chars
    FROM region, (VALUES ('glob'), ('stream')) r(reader))"""))
def q_landed_rejects(spark, sf_dir):
    """ST-01: the files that do not parse, with their texts."""
    d = _by_both_readers(spark, sf_dir, 1)
    return d.select("reader", F.regexp_extract("file", "page=([^/]+)/", 1).alias("page"), F.regexp_extract("payload", '"id": "([^"]+)"', 1).alias("region"),
                    F.length(F.regexp_replace("payload", "\\s+$", "")).alias("n_chars"))
