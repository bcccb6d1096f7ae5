"""Registered queries: station catalogue feed, forecast periods, JSON shape coverage,
earthquake lookback and extent filters, alerts from two fetch strategies.

As in ``queries_io``, whole test tables are serialised into the feed format
with ``to_json`` and parsed back through the feed flatteners, so the parsing
code runs over every row of the table.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import catalog as cat
from tidewatch.plans.oracle import _meta, sql
from tidewatch.plans.registry import out_sql, register
from tidewatch.sources import bind
from tidewatch.sources import envelopes as env

# Run parameter (the reference takes the box from its source register):
# min_lat, max_lat, min_lon, max_lon, inclusive.
CATALOG_BBOX = (17.8, 18.6, -67.5, -65.0)


def _names(spec):
    return [c.split(":")[0].strip() for c in spec.split(",")]


# ---------------- S-01 + A-12 + F-03..F-06 station catalogue -----------------

def _catalog_docs(spark, sf_dir):
    """One catalogue document per event row: stations repeat, some entries
    carry (0, 0), a missing latitude or a position outside the box, and some
    have no datum flag."""
    ev = bind.read_table(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    m = bind.station_meta_columns(uid)
    lat = (F.when(eid % 29 == 0, F.lit(0.0)).when(eid % 31 == 0, F.lit(None).cast("double"))
           .when(eid % 37 == 0, m["lat"] + F.lit(1.0)).otherwise(m["lat"]))
    lng = F.when(eid % 29 == 0, F.lit(0.0)).otherwise(m["lon"])
    tidal = (F.when(uid % 10 == 9, F.lit(False))
             .when((uid % 10 == 8) & (eid % 2 == 0), F.lit(None).cast("boolean")).otherwise(F.lit(True)))
    entry = F.struct(uid.cast("string").alias("id"), m["station_name"].alias("name"), F.lit("PR").alias("state"),
                     lat.alias("lat"), lng.alias("lng"), m["shefcode"].alias("shefcode"), tidal.alias("tidal"))
    return ev.select(eid.alias("seq"), F.to_json(F.struct(F.array(entry).alias("stations"))).alias("payload"))


def _metadata(spark, sf_dir):
    """Station metadata entries by supplier: position ((0, 0) for every fifth), and the fallback position."""
    s = bind.read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    m = bind.station_meta_columns(k)
    zero = F.lit(0.0)
    return s.select(k.cast("string").alias("id"), F.when(k % 5 == 0, zero).otherwise(m["lat"]).alias("md_lat"),
                    F.when(k % 5 == 0, zero).otherwise(m["lon"]).alias("md_lng"), m["lat"].alias("fb_lat"), m["lon"].alias("fb_lon"))


CATALOG = "id, name, state, lat:d, lng:d, shefcode, tidal, coord_source, seq:l"

_M = _meta("user_id")
_MS = _meta("s_suppkey")


@register("station_catalog", out_sql(CATALOG, f"""(
    WITH e AS (
      SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, {_M['station_name']} AS name, 'PR' AS state,
        CASE WHEN event_id % 29 = 0 THEN 0.0::DOUBLE WHEN event_id % 31 = 0 THEN NULL
             WHEN event_id % 37 = 0 THEN {_M['lat']} + 1.0::DOUBLE ELSE {_M['lat']} END AS lat,
        CASE WHEN event_id % 29 = 0 THEN 0.0::DOUBLE ELSE {_M['lon']} END AS lng,
        {_M['shefcode']} AS shefcode,
        CASE WHEN user_id % 10 = 9 THEN false WHEN user_id % 10 = 8 AND event_id % 2 = 0 THEN NULL
             ELSE true END AS tidal
      FROM events),
    box AS (SELECT * FROM e WHERE lat BETWEEN {CATALOG_BBOX[0]} AND {CATALOG_BBOX[1]}
              AND lng BETWEEN {CATALOG_BBOX[2]} AND {CATALOG_BBOX[3]}),
    f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS k FROM box) WHERE k = 1),
    md AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 5 = 0 THEN 0.0::DOUBLE ELSE {_MS['lat']} END AS md_lat,
             CASE WHEN s_suppkey % 5 = 0 THEN 0.0::DOUBLE ELSE {_MS['lon']} END AS md_lng, {_MS['lat']} AS fb_lat, {_MS['lon']} AS fb_lon
           FROM supplier),
    j AS (SELECT f.* EXCLUDE (lat, lng), coalesce(md_lat, lat) AS lat, coalesce(md_lng, lng) AS lng, fb_lat, fb_lon
          FROM f LEFT JOIN md ON f.id = md.id),
    r AS (SELECT *, (abs(lat) >= 1e-9 OR abs(lng) >= 1e-9) AND lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AS ok FROM j)
    SELECT id, name, state, shefcode, tidal, seq, CASE WHEN ok THEN lat ELSE fb_lat END AS lat,
      CASE WHEN ok THEN lng ELSE fb_lon END AS lng, CASE WHEN ok THEN 'feed' ELSE 'fallback' END AS coord_source
    FROM r WHERE (ok OR fb_lat IS NOT NULL) AND coalesce(tidal, false))""",
    order="id"))
def q_station_catalog(spark, sf_dir):
    """S-01 catalogue envelopes -> F-03 box -> A-12 first entry per id -> metadata
    step: F-04/F-05 coordinate repair and F-06 datum filter -> L-02 sorted by id."""
    docs = _catalog_docs(spark, sf_dir)
    doc = docs.select("seq", F.from_json("payload", env.CATALOG_SCHEMA).alias("_d")).select("seq", "_d.*")
    rows = cat.in_catalog_box(env.flatten_catalog(doc, keep=("seq",)), CATALOG_BBOX, lat="lat", lon="lng")
    first = cat.dedupe_first(rows, "id", "seq")
    md = _metadata(spark, sf_dir)
    placed = first.join(md.select("id", "md_lat", "md_lng"), "id", "left").withColumns(
        {"lat": F.coalesce("md_lat", "lat"), "lng": F.coalesce("md_lng", "lng")}).drop("md_lat", "md_lng")
    fixed = cat.with_coordinate_fallback(placed, md.select("id", "fb_lat", "fb_lon"), "id", lat="lat", lon="lng")
    return cat.on_tidal_datum(fixed).select(*_names(CATALOG)).orderBy("id")


# ---------------- S-06 + T-11 + D-DT2/D-DT3 forecast periods -----------------

def _forecast_docs(spark, sf_dir):
    """One forecast document per line item, one period each; start times carry
    a -04:00 offset, and line 7 has an unparseable start time."""
    li = bind.read_table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    start = F.when(ln == 7, F.lit("not a time")).otherwise(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-04:00")))
    wind_dir = (F.when(F.col("l_returnflag") == "A", F.lit("NE"))
                .when(F.col("l_returnflag") == "N", F.lit("N")).otherwise(F.lit("SW")))
    period = F.struct(
        F.concat(F.lit("Period "), ln.cast("string")).alias("name"), start.alias("startTime"),
        (F.col("l_quantity").cast("int") + F.lit(40)).alias("temperature"), F.lit("F").alias("temperatureUnit"),
        F.concat((ln * 3).cast("string"), F.lit(" mph")).alias("windSpeed"), wind_dir.alias("windDirection"),
        F.when(F.col("l_discount") >= 0.05, F.lit("Showers")).otherwise(F.lit("Sunny")).alias("shortForecast"),
        F.lit(None).cast("string").alias("detailedForecast"))
    doc = F.struct(F.struct(F.array(period).alias("periods")).alias("properties"))
    return li.select(F.to_json(doc).alias("payload"))


FORECAST = "period_name, start_time, start_date, temp, wind, short_forecast"


@register("forecast_periods", out_sql(FORECAST, """(
    SELECT 'Period ' || CAST(l_linenumber AS VARCHAR) AS period_name,
      CASE WHEN l_linenumber <> 7 THEN date_trunc('second', l_shipdate) + INTERVAL 4 HOUR END AS start_time,
      CASE WHEN l_linenumber <> 7 THEN strftime(date_trunc('second', l_shipdate) + INTERVAL 4 HOUR, '%Y-%m-%d')
        END AS start_date,
      CAST(CAST(trunc(l_quantity) AS INTEGER) + 40 AS VARCHAR) || ' F' AS temp,
      CAST(l_linenumber * 3 AS VARCHAR) || ' mph ' ||
        CASE WHEN l_returnflag = 'A' THEN 'NE' WHEN l_returnflag = 'N' THEN 'N' ELSE 'SW' END AS wind,
      CASE WHEN l_discount >= 0.05 THEN 'Showers' ELSE 'Sunny' END AS short_forecast
    FROM lineitem)"""))
def q_forecast(spark, sf_dir):
    """S-06: forecast periods -> rows; T-11 value-with-unit text; D-DT2 offset
    times to UTC (unparseable -> null); D-DT3 date text."""
    p = env.flatten_forecast(env._parse(_forecast_docs(spark, sf_dir), "payload", env.FORECAST_SCHEMA))
    p = p.withColumn("start_date", F.date_format("start_time", "yyyy-MM-dd"))
    return p.withColumn("start_time", F.col("start_time").cast("timestamp_ntz")).select(*_names(FORECAST))


# ---------------- A-21 JSON shape coverage -----------------

@register("json_type_coverage", out_sql("field, value_type, n:l", """(
    SELECT 'qualifier' AS field,
      CASE WHEN p_partkey % 3 = 0 THEN 'ARRAY<STRING>' WHEN p_partkey % 3 = 1 THEN 'STRING' ELSE 'VOID' END
        AS value_type,
      count(*) AS n
    FROM part GROUP BY 2)"""))
def q_type_coverage(spark, sf_dir):
    """A-21: how many features carry each JSON shape of the list-or-scalar
    ``qualifier`` (list, text, JSON null; ``NULL`` when the field is absent)."""
    from tidewatch.plans.queries_io import _water_docs
    schema = "struct<features: array<struct<properties: struct<qualifier: variant>>>>"
    f = _water_docs(spark, sf_dir).select(F.explode(F.from_json("payload", schema)["features"]).alias("f"))
    q = F.col("f.properties.qualifier")
    return (f.groupBy(F.coalesce(F.schema_of_variant(q), F.lit("NULL")).alias("value_type")).count()
            .select(F.lit("qualifier").alias("field"), "value_type", F.col("count").alias("n")))


# ---------------- F-09 + F-10 earthquake lookback, magnitude and extent -----------------

# Run parameters: the feed's default lookback, a minimum magnitude with no
# maximum, a latitude band and only an eastern longitude limit (every bound
# is optional).
QUAKE_LOOKBACK_DAYS = 30
QUAKE_BOUNDS = {"magnitude": (2.5, None), "latitude": (17.5, 19.0), "longitude": (None, -65.5)}

QX = "event_id:l, time_utc, magnitude:d, depth_km:d, latitude:d, longitude:d, place"


@register("earthquakes_in_extent", sql(out_sql(QX, f"""(
    SELECT * FROM quakes
    WHERE time_utc >= (SELECT as_of FROM as_of) - INTERVAL {QUAKE_LOOKBACK_DAYS} DAY
      AND time_utc <= (SELECT as_of FROM as_of)
      AND magnitude >= 2.5 AND latitude >= 17.5 AND latitude <= 19.0 AND longitude <= -65.5)"""),
    "quakes", "as_of"))
def q_quakes_extent(spark, sf_dir):
    """F-09 lookback from the data's run time, then F-10: optional magnitude
    and extent bounds combined into one predicate (pushed into the scan stage)."""
    from tidewatch.functions.numeric import bounds_predicate
    from tidewatch.operators.timeseries import lookback
    q = lookback(bind.earthquakes(spark, sf_dir), bind.series_as_of(spark, sf_dir), QUAKE_LOOKBACK_DAYS * 24.0)
    return q.filter(bounds_predicate(QUAKE_BOUNDS)).select(*_names(QX))


# ---------------- U-02 + A-13 two fetch strategies, appended and de-duplicated -----------------

TWO = "id, event, severity, sent, fetch_seq:l, fetch_strategy"


@register("alerts_two_fetches", sql(out_sql(TWO, f"""(
    WITH f1 AS (SELECT id, event, severity, sent, 1 AS fetch_seq FROM alerts
                WHERE strpos(lower(event), 'flood') > 0),
    f2 AS (SELECT a.id, a.event, a.severity, a.sent, 2 AS fetch_seq
           FROM alerts a JOIN alert_zones z ON a.alert_key = z.alert_key),
    u AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2)
    SELECT id, event, severity, sent, max(fetch_seq) AS fetch_seq,
      CASE WHEN max(fetch_seq) = 1 THEN 'area' ELSE 'zone' END AS fetch_strategy
    FROM u GROUP BY id, event, severity, sent)"""), "alerts", "alert_zones"))
def q_two_fetches(spark, sf_dir):
    """U-02: alerts from an event-based fetch and from a fetch for every zone (one
    copy per zone line) appended, then A-13 last seen wins per id --
    a partial aggregate, so an alert repeated across many zones ships one row
    per map task."""
    from tidewatch.operators.alerts import dedupe_last_seen
    a = bind.alerts(spark, sf_dir).select("id", "alert_key", "event", "severity", "sent")
    f1 = a.filter(F.lower("event").contains("flood")).select("id", "event", "severity", "sent",
                                                              F.lit(1).alias("fetch_seq"))
    f2 = a.join(bind.alert_zones(spark, sf_dir), "alert_key").select("id", "event", "severity", "sent", F.lit(2).alias("fetch_seq"))
    d = dedupe_last_seen(f1.unionByName(f2), "id", "fetch_seq")
    return d.withColumn("fetch_strategy", F.when(F.col("fetch_seq") == 1, "area").otherwise("zone")) \
        .select(*_names(TWO))


# ---------------- F-18 list-typed values + F-01 -----------------

@register("water_multi_qualifier", out_sql("timeseries_id, qualifier_count:l, qualifier_text", """(
    SELECT 'TS' || CAST(p_partkey AS VARCHAR) AS timeseries_id, CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 2 END AS qualifier_count,
      CASE WHEN p_partkey % 6 = 0 THEN 'A' ELSE 'A, e' END AS qualifier_text
    FROM part WHERE p_partkey % 3 = 0)"""))
def q_multi_qualifier(spark, sf_dir):
    """F-18: features whose list-or-scalar qualifier is a list, of any length;
    F-01 keeps the listed output columns that exist (``unit_label`` does not)."""
    from tidewatch.functions.arrays import join_list, select_existing
    from tidewatch.plans.queries_io import _water_docs
    w = env.flatten_water(env._parse(_water_docs(spark, sf_dir), "payload", env.WATER_SCHEMA))
    w = w.filter(F.col("qualifier_is_list")).withColumns({
        "qualifier_count": F.size("qualifier").cast("long"), "qualifier_text": join_list("qualifier", ", ")})
    return select_existing(w, ["timeseries_id", "qualifier_count", "unit_label", "qualifier_text"])


# ---------------- L-03 top-n report, L-04 capped sorted id list -----------------

TOP_N = 10            # preview size of the priority report

TOPN = "municipio, priority_index_conf_adj:d, priority_band"


@register("top_priority_areas", sql(out_sql(TOPN, f"""(
    SELECT municipio, priority_index_conf_adj, priority_band FROM scored
    ORDER BY priority_index_conf_adj DESC NULLS LAST, municipio LIMIT {TOP_N})"""), "scored"))
def q_top_priority(spark, sf_dir):
    """L-03: the top-n preview of the priority report (the limit is the
    feature).  ``orderBy().limit(n)`` plans as a per-partition top-n followed
    by one merge of at most n rows per partition."""
    from tidewatch.plans import areas as A
    s = A.scored_indices(spark, sf_dir)
    return (s.orderBy(F.col("priority_index_conf_adj").desc_nulls_last(), F.col("municipio")).limit(TOP_N)
             .select(*_names(TOPN)))


@register("capped_station_list", sql(out_sql("station_id:l", """(
    SELECT DISTINCT station_id FROM tidal_series)""", order="CAST(station_id AS VARCHAR)"), "tidal_series"))
def q_capped_stations(spark, sf_dir):
    """L-04: the catalogue's station ids in text order; the cap guards downloads and is off here."""
    from tidewatch.plans.stations import tidal_series
    return cat.sorted_ids(tidal_series(spark, sf_dir))


# ---------------- J-04 name lookup with fallback to the key -----------------

@register("alert_zone_names", out_sql("zone_id, zone_name, n_alert_lines:l", """(
    SELECT zone_id, coalesce(r_name, zone_id) AS zone_name, count(*) AS n_alert_lines
    FROM (SELECT 'PRZ' || lpad(CAST(l_suppkey % 13 + 1 AS VARCHAR), 3, '0') AS zone_id, l_suppkey % 13 + 1 AS n FROM lineitem)
      LEFT JOIN region ON r_regionkey = n
    GROUP BY zone_id, r_name)"""))
def q_zone_names(spark, sf_dir):
    """J-04: alert lines per zone with the zone's name from a reference (the
    region table, which lacks most zones), falling back to the zone id.  The
    counts are a partial aggregate; the reference is joined after it."""
    from tidewatch.functions.text import zero_pad_code
    ref = bind.read_table(spark, sf_dir, "region").select(
        F.concat(F.lit("PRZ"), zero_pad_code(F.col("r_regionkey"), 3)).alias("zone_id"), F.col("r_name").alias("name"))
    n = bind.alert_zones(spark, sf_dir).groupBy("zone_id").agg(F.count(F.lit(1)).alias("n_alert_lines"))
    j = n.join(ref, "zone_id", "left")
    return j.select("zone_id", F.coalesce("name", "zone_id").alias("zone_name"), "n_alert_lines")


# ---------------- SP-02 earthquake maximum with the spec's piecewise depth factor -----------------

def _spec_depth_sql(depth: str) -> str:
    from tidewatch.config import EQ_SPEC_DEPTH_ELSE, EQ_SPEC_DEPTH_STEPS
    d = f"coalesce({depth}, 0.0::DOUBLE)"
    whens = " ".join(f"WHEN {d} <= {lim} THEN {fac}::DOUBLE" for lim, fac in EQ_SPEC_DEPTH_STEPS)
    return f"CASE {whens} ELSE {EQ_SPEC_DEPTH_ELSE}::DOUBLE END"


def _quake_spec_sql() -> str:
    from tidewatch import config as C
    from tidewatch.plans import oracle as O
    hav = O._haversine("a.latitude", "a.longitude", "q.latitude", "q.longitude")
    age = O._hours("(SELECT as_of FROM as_of)", "q.time_utc")
    return sql(out_sql("area_id:l, earthquake_raw_spec:d", f"""(
        SELECT a.area_id, max(
          coalesce(q.magnitude, 0.0::DOUBLE) / ln(1 + greatest({hav}, {C.EQ_MIN_DIST_KM}::DOUBLE))
          * {_spec_depth_sql('q.depth_km')}
          * exp(-greatest({age}, 0.0::DOUBLE) / {C.EQ_RECENCY_HOURS}::DOUBLE)) AS earthquake_raw_spec
        FROM located_areas a CROSS JOIN quakes q GROUP BY a.area_id)"""), "located_areas", "quakes", "as_of")


@register("earthquake_spec_intensity", _quake_spec_sql())
def q_quake_spec(spark, sf_dir):
    """SP-02: per-area earthquake maximum (M-09) with the spec's piecewise
    depth factor 1.0 / 0.7 / 0.4 instead of 1 / (1 + depth / 70); same
    reduction by location and the same kernel plan as the hazard stage."""
    from tidewatch.functions.geo import depth_factor_spec
    from tidewatch.operators.spatial import area_quake_raw
    from tidewatch.plans import areas as A
    areas = A.area_features(spark, sf_dir)
    q = area_quake_raw(areas, bind.earthquakes(spark, sf_dir), bind.series_as_of(spark, sf_dir),
                       depth_fn=depth_factor_spec)
    return q.select("area_id", F.col("earthquake_raw").alias("earthquake_raw_spec"))
