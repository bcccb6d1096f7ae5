"""Registered queries for sources (JSON envelopes), sinks, alert tables and lookups.

Envelope queries serialise whole test tables into the feed formats with
``to_json`` and parse them back through the same flatteners the file readers
use, so the parsing code runs over every row.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.text import zero_pad_code
from tidewatch.operators import alerts as al
from tidewatch.plans import oracle as _O
from tidewatch.plans.oracle import sql
from tidewatch.plans.registry import out_sql, register
from tidewatch.sources import bind
from tidewatch.sources import envelopes as env


def _names(spec):
    return [c.split(":")[0].strip() for c in spec.split(",")]


# ---------------- S-03 observation envelopes -----------------

def _obs_docs(spark, sf_dir):
    ev = bind.read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    err = (F.when(eid % 101 == 0, F.struct(F.lit("No data was found. This product may not be offered").alias("message")))
           .when(eid % 103 == 0, F.struct(F.lit("Station is offline").alias("message"))))
    wl = F.when(eid % 17 == 0, F.lit("")).otherwise((F.col("value") / 10.0).cast("string"))
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t"), wl.alias("v"),
                   F.lit(None).cast("string").alias("s"), F.lit("0,0,0,0").alias("f"), F.col("event_type").alias("q"))
    doc = F.struct(F.col("user_id").cast("string").alias("station_id"), err.alias("error"),
                   F.when(err.isNull(), F.array(rec)).alias("data"))
    return ev.select(F.to_json(doc).alias("payload"))


OBS = "station_id, time_utc, water_level:d, sigma:d, flags, quality"


@register("observation_envelopes", sql(out_sql(OBS, """(
    SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS time_utc,
      CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 10.0::DOUBLE END AS water_level, NULL::DOUBLE AS sigma,
      '0,0,0,0' AS flags, event_type AS quality
    FROM events WHERE NOT (event_id % 101 = 0 OR event_id % 103 = 0))""")))
def q_obs(spark, sf_dir):
    """S-03: parse observation envelopes; 'No data' -> empty, other errors -> rejects."""
    rows, _ = env.split_observations(env._parse(_obs_docs(spark, sf_dir), "payload", env.OBS_SCHEMA))
    return rows.withColumn("time_utc", F.col("time_utc").cast("timestamp_ntz"))


@register("observation_rejects", sql(out_sql("station_id, error_message", """(
    SELECT CAST(user_id AS VARCHAR) AS station_id, 'Station is offline' AS error_message
    FROM events WHERE event_id % 103 = 0 AND event_id % 101 <> 0)""")))
def q_obs_rejects(spark, sf_dir):
    _, rej = env.split_observations(env._parse(_obs_docs(spark, sf_dir), "payload", env.OBS_SCHEMA))
    return rej


# ---------------- S-04 alert FeatureCollection -----------------

def _alert_docs(spark, sf_dir):
    a = bind.alerts(spark, sf_dir)
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    zone = F.concat(F.lit("PRZ"), F.lpad(((F.col("alert_key") % 13) + 1).cast("string"), 3, "0"))
    ugc = F.when(F.col("alert_key") % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(zone))
    props = F.struct(
        "id", "event", "severity", "urgency", "certainty", "headline",
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("instruction"),
        F.lit(None).cast("string").alias("response"), F.col("sender_name").alias("senderName"),
        F.date_format("sent", iso).alias("sent"), F.date_format("onset", iso).alias("onset"),
        F.date_format("ends", iso).alias("ends"), F.date_format("ends", iso).alias("expires"), "status",
        F.col("area_desc").alias("areaDesc"),
        F.transform(ugc, lambda z: F.concat(F.lit("https://zones/"), z)).alias("affectedZones"),
        F.struct(ugc.alias("UGC")).alias("geocode"))
    feat = F.struct(F.col("id"), props.alias("properties"))
    return a.select(F.to_json(F.struct(F.array(feat).alias("features"))).alias("payload"))


ALERT_FEAT = "id, event, severity, sender_name, sent, onset, ends, status, area_desc, zones, ugc_list, alert_score:l"


@register("alert_features", sql(out_sql(ALERT_FEAT, f"""(
    SELECT id, event, severity, sender_name, sent, onset, ends, status, area_desc,
      CASE WHEN alert_key % 9 = 0 THEN [area_desc]
           ELSE ['PRZ' || lpad(CAST(alert_key % 13 + 1 AS VARCHAR), 3, '0')] END AS zones,
      CASE WHEN alert_key % 9 = 0 THEN '' ELSE 'PRZ' || lpad(CAST(alert_key % 13 + 1 AS VARCHAR), 3, '0') END
        AS ugc_list,
      alert_score
    FROM scored_alerts)"""), "scored_alerts"))
def q_alert_features(spark, sf_dir):
    """S-04 + T-08 + T-09: zones from the affected-zone URLs, area text when none."""
    from tidewatch.functions.arrays import or_fallback
    from tidewatch.functions.text import last_path_segment
    a = env.flatten_alerts(env._parse(_alert_docs(spark, sf_dir), "payload", env.ALERTS_SCHEMA))
    a = a.withColumn("zones", or_fallback(F.transform("affected_zones", lambda u: last_path_segment(u)),
                                          F.col("area_desc")))
    a = al.alert_score(a)
    for c in ("sent", "onset", "ends"):
        a = a.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return a.select(*_names(ALERT_FEAT))


# ---------------- S-07 earthquake FeatureCollection -----------------

def _quake_docs(spark, sf_dir):
    q = bind.earthquakes(spark, sf_dir)
    coords = F.array(F.col("longitude"), F.col("latitude"), F.col("depth_km"))
    props = F.struct(F.unix_millis(F.col("time_utc").cast("timestamp")).alias("time"),
                     F.unix_millis(F.col("time_utc").cast("timestamp")).alias("updated"),
                     F.col("magnitude").alias("mag"), "place", "status", F.lit(None).cast("string").alias("alert"),
                     F.lit(0).alias("tsunami"))
    feat = F.struct(F.concat(F.lit("pr"), F.col("event_id").cast("string")).alias("id"), props.alias("properties"),
                    F.struct(coords.alias("coordinates")).alias("geometry"))
    return q.select(F.to_json(F.struct(F.array(feat).alias("features"))).alias("payload"))


QF = "event_id, time_utc, magnitude:d, depth_km:d, longitude:d, latitude:d, place, status, tsunami:l"


@register("earthquake_features", sql(out_sql(QF, """(
    SELECT 'pr' || CAST(event_id AS VARCHAR) AS event_id, make_timestamp((epoch_us(time_utc) // 1000) * 1000) AS time_utc, magnitude,
      depth_km, longitude, latitude, place, status, 0 AS tsunami
    FROM quakes)"""), "quakes"))
def q_quake_features(spark, sf_dir):
    """S-07 + D-DT1: epoch ms -> timestamp, coordinates [lon, lat, depth] with null-safe access."""
    q = env.flatten_quakes(env._parse(_quake_docs(spark, sf_dir), "payload", env.QUAKE_SCHEMA))
    return q.withColumn("time_utc", F.col("time_utc").cast("timestamp_ntz")).select(*_names(QF))


# ---------------- S-09 header-row payloads -----------------

ACS_COLS = ["NAME", "B01003_001E", "B19013_001E", "B17001_001E", "B17001_002E"]


@register("acs_header_table", sql(out_sql(
    "NAME, population:d, median_income:d, poverty_universe:d, poverty_count:d", """(
    SELECT municipio AS NAME, population, median_income, poverty_universe, poverty_count FROM acs_muni_raw)"""),
    "acs_muni_raw"))
def q_acs_header(spark, sf_dir):
    """S-09: array-of-arrays payload with a header row -> typed table (F-02 rename, F-07 coercion)."""
    raw = bind.acs_municipio(spark, sf_dir)
    header = F.array(*[F.lit(c) for c in ACS_COLS])
    vals = F.array(F.col("municipio"), *[F.col(c).cast("string") for c in
                                         ("population", "median_income", "poverty_universe", "poverty_count")])
    payload = raw.select(F.to_json(F.array(header, vals)).alias("payload"))
    t = env.header_table(payload, "payload", ACS_COLS)
    ren = dict(zip(ACS_COLS[1:], ["population", "median_income", "poverty_universe", "poverty_count"]))
    t = t.withColumnsRenamed(ren)
    return t.select("NAME", *[F.col(c).try_cast("double").alias(c) for c in ren.values()])


# ---------------- S-08 + D-29 daily water with code tables -----------------

def _water_docs(spark, sf_dir):
    p = bind.read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    qual = (F.when(k % 6 == 0, F.to_json(F.array(F.lit("A")))).when(k % 3 == 0, F.to_json(F.array(F.lit("A"), F.lit("e"))))
            .when(k % 3 == 1, F.lit('"P"')))
    props = F.struct(F.concat(F.lit("TS"), k.cast("string")).alias("timeseries_id"),
                     F.concat(F.lit("USGS-"), F.lpad((k % 50).cast("string"), 8, "0")).alias("monitoring_location_id"),
                     F.col("p_retailprice").cast("string").alias("value"), F.lit("Approved").alias("approval_status"),
                     F.lit(None).cast("string").alias("last_modified"),
                     F.col("p_size").cast("string").alias("parameter_code"),
                     ((k % 4) + 1).cast("string").alias("statistic_id"), F.lit("ft3/s").alias("unit_of_measure"),
                     F.lit("2024-01-01").alias("time"), F.lit("QUALIFIER").alias("qualifier"))
    geom = F.struct(F.lit("Point").alias("type"),
                    F.array((F.lit(-67.0) + (k % 200) / 100.0), (F.lit(18.0) + (k % 50) / 100.0)).alias("coordinates"))
    feat = F.to_json(F.struct(props.alias("properties"), geom.alias("geometry")))
    # splice the raw qualifier JSON (list, text or null) in place of the placeholder
    feat = F.replace(feat, F.lit('"qualifier":"QUALIFIER"'),
                     F.concat(F.lit('"qualifier":'), F.coalesce(qual, F.lit("null"))))
    return p.select(F.concat(F.lit('{"features":['), feat, F.lit("]}")).alias("payload"))


WATER = ("timeseries_id, value:d, parameter_code, statistic_id, qualifier, parameter_name, statistic_name, "
         "latitude:d, longitude:d")


@register("daily_water", sql(out_sql(WATER, """(
    SELECT 'TS' || CAST(p_partkey AS VARCHAR) AS timeseries_id, p_retailprice AS value,
      lpad(CAST(p_size AS VARCHAR), 5, '0') AS parameter_code,
      lpad(CAST(p_partkey % 4 + 1 AS VARCHAR), 5, '0') AS statistic_id,
      CASE WHEN p_partkey % 6 = 0 THEN 'A' WHEN p_partkey % 3 = 0 THEN 'A - e' WHEN p_partkey % 3 = 1 THEN 'P' END AS qualifier,
      r.r_name AS parameter_name, n.n_name AS statistic_name,
      18.0::DOUBLE + (p_partkey % 50) / 100.0::DOUBLE AS latitude,
      -67.0::DOUBLE + (p_partkey % 200) / 100.0::DOUBLE AS longitude
    FROM part
    LEFT JOIN region r ON lpad(CAST(r.r_regionkey AS VARCHAR), 5, '0') = lpad(CAST(p_size AS VARCHAR), 5, '0')
    LEFT JOIN nation n ON lpad(CAST(n.n_nationkey AS VARCHAR), 5, '0') = lpad(CAST(p_partkey % 4 + 1 AS VARCHAR), 5, '0'))""")))
def q_daily_water(spark, sf_dir):
    """D-29: multi-page features -> table, T-04 zero-padded codes, J-01 / J-02 code lookups, R-03 + T-10."""
    from tidewatch.functions.arrays import join_list
    from tidewatch.functions.text import zero_pad_code
    w = env.flatten_water(env._parse(_water_docs(spark, sf_dir), "payload", env.WATER_SCHEMA))
    params = bind.read_table(spark, sf_dir, "region").select(
        zero_pad_code(F.col("r_regionkey")).alias("parameter_code"), F.col("r_name").alias("parameter_name"))
    stats = bind.read_table(spark, sf_dir, "nation").select(
        zero_pad_code(F.col("n_nationkey")).alias("statistic_id"), F.col("n_name").alias("statistic_name"))
    # lookups are de-duplicated on the code first so the left joins cannot fan out (Q15)
    params = params.dropDuplicates(["parameter_code"])
    stats = stats.dropDuplicates(["statistic_id"])
    w = (w.withColumn("parameter_code", zero_pad_code(F.col("parameter_code")))
          .withColumn("statistic_id", zero_pad_code(F.col("statistic_id"))))
    w = w.join(params, "parameter_code", "left").join(stats, "statistic_id", "left")
    return w.withColumn("qualifier", join_list("qualifier", " - ")).select(*_names(WATER))


# ---------------- D-28 alerts by zone -----------------

def _zone_docs(spark, sf_dir):
    """Zone reference as FeatureCollections, one per nation: names of towns or of no place, a name
    missing (key % 11 = 5), Polygon, MultiPolygon (odd keys) and no geometry (key % 7 = 3); another
    state (key % 5 = 4) or none (key % 6 = 2)."""
    n = bind.read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    x, y = F.lit(-66.0) - k / 100.0, F.lit(18.0) + k / 100.0
    point = lambda dx, dy: F.array(x + dx, y + dy)
    ring = F.array(point(0.0, 0.0), point(0.1, 0.0), point(0.1, 0.1), point(0.0, 0.1), point(0.0, 0.0))
    hole = F.array(point(0.04, 0.04), point(0.06, 0.04), point(0.04, 0.04))
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring, hole).alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring, hole), F.array(hole)).alias("coordinates")))
    geometry = F.when(k % 7 == 3, F.lit("null")).when(k % 2 == 1, multi).otherwise(polygon)
    name = (F.when(k % 11 == 5, F.lit(None).cast("string")).when(k % 4 == 0, F.concat(F.lit("Zone "), F.col("n_name")))
            .otherwise(F.concat(F.lit("Supplier#"), zero_pad_code(k, 9))))
    props = F.to_json(F.struct(F.concat(F.lit("PRZ"), zero_pad_code(k + 1, 3)).alias("id"), name.alias("name"), F.when(k % 5 == 4, F.lit("VI")).when(k % 6 != 2, F.lit("PR")).alias("state")))
    return n.select(F.concat(F.lit('{"features":[{"properties":'), props, F.lit(',"geometry":'), geometry, F.lit("}]}")).alias("payload"))


def _zone_reference(spark, sf_dir):
    from tidewatch.functions.geo import ring_centroid
    z = env.flatten_zones(env._parse(_zone_docs(spark, sf_dir), "payload", env.ZONES_SCHEMA))
    z = z.withColumn("_c", ring_centroid("rings")).select("zone_id", "zone_name", F.col("_c.lat").alias("zone_lat"),
                                                          F.col("_c.lon").alias("zone_lon"), F.col("state").alias("zone_state"))
    return al.zones_or_fallback(z)


_O.EXTRA_CTES["zone_ref"] = ([], """
    SELECT 'PRZ' || lpad(CAST(k + 1 AS VARCHAR), 3, '0') AS zone_id,
      CASE WHEN k % 4 = 0 THEN 'Zone ' || n_name ELSE 'Supplier#' || lpad(CAST(k AS VARCHAR), 9, '0') END AS zone_name,
      CASE WHEN k % 5 = 4 THEN 'VI' ELSE 'PR' END AS zstate,
      CASE WHEN k % 7 <> 3 THEN ((((la + la) + (la + 0.1::DOUBLE)) + (la + 0.1::DOUBLE)) + la) / 5 END AS zlat,
      CASE WHEN k % 7 <> 3 THEN ((((lo + (lo + 0.1::DOUBLE)) + (lo + 0.1::DOUBLE)) + lo) + lo) / 5 END AS zlon
    FROM (SELECT n_nationkey AS k, n_name, 18.0::DOUBLE + n_nationkey / 100.0::DOUBLE AS la, -66.0::DOUBLE - n_nationkey / 100.0::DOUBLE AS lo
          FROM nation WHERE n_nationkey % 11 <> 5)""")


ABZ = "id, zone_id, event, headline, description, instruction, response, state, severity, urgency, certainty, status, sent, expires, area_desc, latitude:d, longitude:d"
_DESCRIPTION = "CASE WHEN alert_key % 17 = 0 THEN 'Heavy rain over PRZ004' WHEN alert_key % 17 = 1 THEN 'Coastal waters' END"


@register("alerts_by_zone", sql(out_sql(ABZ, f"""(
    WITH a AS (SELECT *, {_DESCRIPTION} AS description, CASE WHEN alert_key % 4 = 0 THEN 'Move to higher ground' END AS instruction,
        CASE WHEN alert_key % 3 = 0 THEN 'Avoid' ELSE 'Monitor' END AS response FROM active_alerts),
    rel AS (SELECT * FROM a WHERE sender_name = 'NWS San Juan PR'
              OR regexp_matches(concat_ws(chr(10), headline, area_desc, description), '(?i)puerto\\s+rico|PRZ\\d{{3}}|AMZ\\d{{3}}|\\bPR\\b')),
    rows AS (SELECT DISTINCT r.id, coalesce(z.zone_id, r.area_desc) AS zone_id, r.event, r.headline, r.description, r.instruction, r.response, r.severity, r.urgency,
               r.certainty, r.status, r.sent, r.ends AS expires
             FROM rel r LEFT JOIN alert_zones z ON r.alert_key = z.alert_key),
    checked AS (SELECT max(o_orderdate) AS t FROM orders),
    ph AS (SELECT 'placeholder_' || zone_id || '_' || strftime((SELECT t FROM checked), '%Y-%m-%dT%H:%M:%S+00:00') AS id, zone_id,
             'No Active Alerts' AS event, 'No Active Alerts for ' || zone_name AS headline, 'N/A' AS description, 'N/A' AS instruction, 'N/A' AS response, 'N/A' AS severity,
             'N/A' AS urgency, 'N/A' AS certainty, 'None' AS status, (SELECT t FROM checked) AS sent, NULL::TIMESTAMP AS expires
           FROM zone_ref WHERE zone_id NOT IN (SELECT zone_id FROM rows)),
    u AS (SELECT x.*, coalesce(zone_name, x.zone_id) AS area_desc, zlat, zlon, zstate
          FROM (SELECT * FROM rows UNION ALL SELECT * FROM ph) x LEFT JOIN zone_ref z ON x.zone_id = z.zone_id)
    SELECT u.*, CASE WHEN t.latitude IS NOT NULL THEN t.latitude ELSE zlat END AS latitude,
      CASE WHEN t.latitude IS NOT NULL THEN t.longitude ELSE coalesce(zlon, t.longitude) END AS longitude,
      CASE WHEN t.latitude IS NOT NULL THEN 'PR' WHEN zlat IS NOT NULL THEN zstate END AS state
    FROM u LEFT JOIN towns t ON u.area_desc = t.designated_area)"""), "active_alerts", "alert_zones", "towns", "zone_ref"))
def q_alerts_by_zone(spark, sf_dir):
    """D-28: relevance filter (F-11), last seen per id (A-13), zones (R-02) or area text,
    placeholders (J-16, U-03, T-13), zone names (J-04), places by name (J-03) and
    centroids of the reference's rings (S-05, R-01, J-05)."""
    k = F.col("alert_key")
    act = bind.active_alerts(spark, sf_dir).withColumns({
        "description": F.when(k % 17 == 0, "Heavy rain over PRZ004").when(k % 17 == 1, "Coastal waters"),
        "instruction": F.when(k % 4 == 0, "Move to higher ground"), "response": F.when(k % 3 == 0, "Avoid").otherwise("Monitor")})
    at = bind.read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    out = al.alerts_by_zone(act, bind.alert_zones(spark, sf_dir), _zone_reference(spark, sf_dir), bind.towns(spark, sf_dir).withColumn("state", F.lit("PR")), at)
    return out.select(*_names(ABZ))
