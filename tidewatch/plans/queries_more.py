"""Registered queries: alert phase / zone scores, selections, radius joins,
exposure zones, alternative normalisers, restoration, lookups and checks."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators import alerts as al
from tidewatch.operators import scoring as sc
from tidewatch.operators import spatial as sp
from tidewatch.plans import areas as A
from tidewatch.plans import oracle as _O
from tidewatch.plans.oracle import sql
from tidewatch.plans.queries_core import _scored_sql
from tidewatch.plans.registry import ORACLE, out_sql, register
from tidewatch.sources import bind


def _names(spec):
    return [c.split(":")[0].strip() for c in spec.split(",")]


_ASOF_O = "(SELECT max(o_orderdate) FROM orders)"


# ---------------- SP-04 / SP-12 / SP-15 -----------------

@register("zone_alert_score", sql(out_sql("zone_id, zone_alert_score:l", f"""(
    SELECT z.zone_id, max(a.alert_score) AS zone_alert_score
    FROM scored_alerts a JOIN alert_zones z ON a.alert_key = z.alert_key
    WHERE a.onset <= {_ASOF_O} AND a.ends > {_ASOF_O} GROUP BY z.zone_id)"""), "scored_alerts", "alert_zones"))
def q_zone_alert(spark, sf_dir):
    """SP-04: per zone, max score over alerts active at the run time."""
    as_of = bind.read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return al.area_alert_score(bind.alerts(spark, sf_dir), bind.alert_zones(spark, sf_dir), as_of)


@register("zone_phase", sql(out_sql("zone_id, phase", f"""(
    SELECT r.zone_id,
      CASE WHEN bool_or(ends > {_ASOF_O} AND event IN ('Flood Warning', 'Flash Flood Warning')) THEN 'DURING'
           WHEN bool_or(ends > {_ASOF_O} AND event = 'Flood Watch') THEN 'PRE'
           WHEN bool_or(ends <= {_ASOF_O}) THEN 'POST' ELSE 'PRE' END AS phase
    FROM zone_ref r LEFT JOIN (
      SELECT z.zone_id, a.event, a.ends FROM alerts a JOIN alert_zones z ON a.alert_key = z.alert_key
      WHERE a.event IN ('Flood Watch', 'Flood Warning', 'Flash Flood Warning')
        AND a.onset <= {_ASOF_O} AND a.ends > {_ASOF_O} - INTERVAL 24 HOUR) x ON x.zone_id = r.zone_id
    GROUP BY r.zone_id)"""), "alerts", "alert_zones", "zone_ref"))
def q_zone_phase(spark, sf_dir):
    """SP-12: named warning active -> DURING, watch active -> PRE, ended within 24 h -> POST; the
    zones are those of the reference (S-05), which has a fallback."""
    from tidewatch.plans.queries_io import _zone_reference
    as_of = bind.read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return al.phase_from_alerts(bind.alerts(spark, sf_dir), bind.alert_zones(spark, sf_dir), _zone_reference(spark, sf_dir), as_of)


@register("forced_bands", sql(out_sql("area_id:l, priority_band, major_exceeded, forced_band", """(
    SELECT s.area_id, s.priority_band, coalesce(m.major_exceeded, false) AS major_exceeded,
      CASE WHEN s.municipio IN (SELECT t.municipio FROM active_alerts x JOIN towns t ON x.area_desc = t.designated_area
                                WHERE strpos(lower(x.event), 'flash flood warning') > 0) THEN 'Red'
           WHEN coalesce(m.major_exceeded, false) AND s.priority_band IN ('Green', 'Yellow') THEN 'Orange'
           ELSE s.priority_band END AS forced_band
    FROM scored s LEFT JOIN (
      SELECT a.area_id, bool_or(f.exceed_ratio >= 1.0) AS major_exceeded
      FROM located_areas a, station_features f
      WHERE 2 * 6371.0::DOUBLE * asin(sqrt(pow(sin(radians(f.lat - a.latitude) / 2), 2) + cos(radians(a.latitude))
            * cos(radians(f.lat)) * pow(sin(radians(f.lon - a.longitude) / 2), 2))) <= 12.0
      GROUP BY a.area_id) m ON s.area_id = m.area_id)"""), "scored", "active_alerts", "located_areas",
    "station_features", "towns"))
def q_forced(spark, sf_dir):
    """SP-15: an active Flash Flood Warning forces Red in the areas of the towns it
    names; a station within 12 km above its major threshold forces at least
    Orange (radius join J-13)."""
    from tidewatch.plans.stations import station_latest_features
    from tidewatch.session import stage_checkpoint
    feats = A.area_features(spark, sf_dir)
    st = stage_checkpoint(station_latest_features(spark, sf_dir))
    s = A.scored_indices(spark, sf_dir, features=feats, stations=st).select("area_id", "municipio", "priority_band")
    pairs = sp.radius_join(feats.select("area_id", "latitude", "longitude"), st.select("lat", "lon", "exceed_ratio"), C.OVERRIDE_KM)
    m = pairs.groupBy("area_id").agg(F.max(F.coalesce(F.col("exceed_ratio") >= 1.0, F.lit(False)))
                                     .alias("major_exceeded"))
    named = bind.active_alerts(spark, sf_dir).filter(F.lower("event").contains("flash flood warning")).select("area_desc").distinct()
    towns = bind.towns(spark, sf_dir).select("designated_area", "municipio")
    warned = named.join(towns, named["area_desc"] == towns["designated_area"]).select("municipio").distinct().withColumn(
        "event", F.lit("Flash Flood Warning"))
    d = s.join(m, "area_id", "left").join(warned, "municipio", "left").withColumn("major_exceeded", F.coalesce("major_exceeded", F.lit(False)))
    return d.select("area_id", "priority_band", "major_exceeded",
                    al.forced_band(F.col("event"), F.col("major_exceeded"), F.col("priority_band")).alias("forced_band"))


# ---------------- D-15 with a bound -----------------

@register("area_hazard_bounded", sql(out_sql("area_id:l, in_bounds, close", """(
    SELECT area_id, true AS in_bounds, true AS close FROM located_areas)"""), "located_areas"))
def q_bounded(spark, sf_dir):
    """D-15: the weighted mean from cell sums of far stations, held against the exact one: it and the proven bounds."""
    from tidewatch.plans.stations import station_latest_features
    from tidewatch.session import stage_checkpoint
    areas = A.area_features(spark, sf_dir).select("area_id", "latitude", "longitude")
    st = stage_checkpoint(station_latest_features(spark, sf_dir).select("lat", "lon", "flood_hazard_final"))
    exact = sp.area_flood_hazard(areas, st, F.lit(0.0)).select("area_id", F.col("flood_hazard_weighted").alias("exact"))
    d = sp.bounded_flood_mean(areas, st).join(exact, "area_id")
    inside = (F.col("exact") >= F.col("mean_lo") - 1e-9) & (F.col("exact") <= F.col("mean_hi") + 1e-9)
    return d.select("area_id", inside.alias("in_bounds"), (F.abs(F.col("flood_hazard_weighted") - F.col("exact")) <= 0.06 * F.col("exact")).alias("close"))


# ---------------- J-13 radius pairs, J-19 nearest centroid -----------------

@register("area_station_pairs", sql(out_sql("area_id:l, station_id:l, dist_km:d", f"""(
    SELECT * FROM (SELECT a.area_id, f.station_id,
        {_O._haversine('a.latitude', 'a.longitude', 'f.lat', 'f.lon')} AS dist_km
      FROM located_areas a, station_features f) WHERE dist_km <= 12.0)"""), "located_areas", "station_features"))
def q_pairs(spark, sf_dir):
    """J-13: area-station pairs within 12 km through the exact grid join."""
    from tidewatch.plans.stations import station_latest_features
    st = station_latest_features(spark, sf_dir).select("station_id", "lat", "lon")
    areas = A.area_features(spark, sf_dir).select("area_id", "latitude", "longitude")
    return sp.radius_join(areas, st, C.OVERRIDE_KM).select("area_id", "station_id", "dist_km")


@register("nearest_area", sql(out_sql("designated_area, area_id:l, dist_km:d", f"""(
    SELECT designated_area, area_id, dist_km FROM (
      SELECT t.designated_area, a.area_id, d AS dist_km, row_number() OVER (PARTITION BY t.designated_area ORDER BY d, a.area_id) AS rn
      FROM towns t LEFT JOIN LATERAL (
        SELECT area_id, {_O._haversine('t.latitude', 't.longitude', 'x.latitude', 'x.longitude')} AS d FROM located_areas x
        WHERE t.latitude IS NOT NULL AND t.longitude IS NOT NULL) a ON TRUE)
    WHERE rn = 1)"""), "towns", "located_areas"))
def q_nearest(spark, sf_dir):
    """J-19 re-aimed: every town with its nearest area centroid, however far; nulls without coordinates."""
    towns = bind.towns(spark, sf_dir).select("designated_area", "latitude", "longitude")
    areas = A.area_features(spark, sf_dir).select("area_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return sp.nearest_join(towns, areas, "designated_area", "area_id")


# ---------------- SP-11 exposure in hazard zones -----------------

@register("exposure_zone", sql(out_sql(
    "area_id:l, towns:l, towns_in_zone:l, pop_in_zone_pct:d, facilities_score:d, exposure_spec:d", f"""(
    WITH hot AS (SELECT lat, lon FROM station_features WHERE sensor_hazard_score >= 50.0),
    tz AS (SELECT t.designated_area, t.municipio_key, t.zip_population, t.latitude, t.longitude,
             EXISTS (SELECT 1 FROM hot h WHERE
               {_O._haversine('t.latitude', 't.longitude', 'h.lat', 'h.lon')} <= 12.0) AS in_zone
           FROM town_risk t),
    per AS (SELECT a.area_id, count(tz.designated_area) AS towns,
              count(*) FILTER (WHERE tz.in_zone) AS towns_in_zone,
              100.0::DOUBLE * sum(CASE WHEN tz.in_zone THEN tz.zip_population ELSE 0 END)
                / nullif(sum(tz.zip_population), 0) AS pop_in_zone_pct
            FROM area_features a LEFT JOIN tz ON a.municipio_key = tz.municipio_key GROUP BY a.area_id)
    SELECT *, 0.7::DOUBLE * pop_in_zone_pct + 0.3::DOUBLE * facilities_score AS exposure_spec FROM (
      SELECT *, {_O._robust('per', 'towns_in_zone::DOUBLE')} AS facilities_score FROM per))"""),
    "station_features", "town_risk", "area_features"))
def q_exposure(spark, sf_dir):
    """SP-11: % of town population inside the hazard influence zone (12 km of a
    station with sensor hazard >= 50) and facilities (towns) in the zone."""
    from tidewatch.plans.stations import station_latest_features
    from tidewatch.functions.numeric import weighted_sum
    hot = station_latest_features(spark, sf_dir).filter(F.col("sensor_hazard_score") >= 50.0).select("lat", "lon")
    towns = A.town_risk(spark, sf_dir).select("designated_area", "municipio_key", "zip_population",
                                              "latitude", "longitude")
    inz = sp.radius_join(towns, hot, C.OVERRIDE_KM).select("designated_area").distinct() \
        .withColumn("in_zone", F.lit(True))
    t = towns.join(inz, "designated_area", "left").withColumn("in_zone", F.coalesce("in_zone", F.lit(False)))
    areas = A.area_features(spark, sf_dir).select("area_id", "municipio_key")
    per = areas.join(t, "municipio_key", "left").groupBy("area_id").agg(
        F.count("designated_area").alias("towns"),
        F.count_if(F.col("in_zone")).alias("towns_in_zone"),
        (F.lit(100.0) * F.try_divide(F.sum(F.when(F.col("in_zone"), F.col("zip_population")).otherwise(0.0)),
                                     F.sum("zip_population"))).alias("pop_in_zone_pct"))
    per = sc.robust_score(per, "towns_in_zone", "facilities_score")
    w = C.SPEC_EXPOSURE_WEIGHTS
    return per.withColumn("exposure_spec", weighted_sum([("pop_in_zone_pct", w["pop_in_zone_pct"]),
                                                         ("facilities_score", w["critical_facilities_in_zone"])]))


# ---------------- SP-26 alternative normalisers -----------------

@register("alt_normalisers", sql(out_sql("area_id:l, population:d, z_population:d, q_population:d", """(
    SELECT area_id, population,
      (population - (SELECT avg(population) FROM area_features))
        / nullif((SELECT stddev_samp(population) FROM area_features), 0) AS z_population,
      CASE WHEN population IS NOT NULL THEN
        (rank() OVER (ORDER BY population ASC NULLS LAST, area_id) - 1)::DOUBLE
          / nullif(count(*) OVER () - 1, 0) * 100.0 END AS q_population
    FROM area_features)"""), "area_features"))
def q_alt_norm(spark, sf_dir):
    """SP-26: z-score and quantile (percent-rank) scores of population."""
    f = A.area_features(spark, sf_dir).select("area_id", "population")
    f = sc.zscore(f, "population", "z_population")
    return sc.quantile_score(f, "population", "q_population", "area_id")


# ---------------- SP-27 restoration velocity -----------------

@register("restoration_velocity", sql(out_sql("area_id:l, day, restored_pct:d, velocity_pct_per_day:d", """(
    SELECT area_id, day, restored_pct,
      (restored_pct - lag(restored_pct) OVER w)
        / (date_diff('day', lag(day) OVER w, day))::DOUBLE AS velocity_pct_per_day
    FROM (SELECT CAST(c_nationkey AS BIGINT) AS area_id, CAST(o_orderdate AS DATE) AS day,
            100.0::DOUBLE * avg((o_orderstatus = 'F')::INT::DOUBLE) AS restored_pct
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY area_id ORDER BY day))""")))
def q_restoration(spark, sf_dir):
    """SP-27: daily restored share per area and its change per day (lag over
    the (area, day) table, one row per area and day)."""
    o = bind.read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    c = bind.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    d = o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("c_nationkey").cast("long").alias("area_id"), F.to_date("o_orderdate").alias("day")).agg(
        (F.avg((F.col("o_orderstatus") == "F").cast("double")) * 100.0).alias("restored_pct"))
    w = Window.partitionBy("area_id").orderBy("day")
    return d.withColumn("velocity_pct_per_day", (F.col("restored_pct") - F.lag("restored_pct").over(w))
                        / F.datediff("day", F.lag("day").over(w)).cast("double"))


# ---------------- SP-27 route access: travel time, viable routes -----------------

ROUTES = ("area_id:l, trips:l, viable_route_share_pct:d, median_travel_min:d, median_baseline_min:d, "
          "delta_travel_min:d, mean_delay_pct:d")


@register("route_access", out_sql(ROUTES, """(
    WITH t AS (
      SELECT CAST(s_nationkey AS BIGINT) AS area_id, CAST(floor(l_quantity) AS BIGINT) + 10 AS baseline_min,
        CASE WHEN l_returnflag = 'R' THEN NULL
             ELSE CAST(floor(l_quantity) AS BIGINT) + 10 + l_linenumber * (l_orderkey % 3) END AS travel_min
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
    SELECT area_id, count(*) AS trips,
      100.0 * avg(CASE WHEN travel_min IS NOT NULL THEN 1.0 ELSE 0.0 END) AS viable_route_share_pct,
      median(travel_min) AS median_travel_min, median(baseline_min) AS median_baseline_min,
      median(travel_min) - median(baseline_min) AS delta_travel_min,
      100.0 * avg((travel_min - baseline_min)::DOUBLE / baseline_min) AS mean_delay_pct
    FROM t GROUP BY area_id)"""))
def q_routes(spark, sf_dir):
    """SP-27 (travel part): per area, share of viable routes, median travel
    time, its change against the baseline median, mean delay.  Trips are line
    items (supplier nation = area, quantity + 10 = baseline minutes, return
    flag R = route blocked).  All measures come from one pre-aggregated
    (area, baseline, travel) count table; the medians are exact and
    skew-safe (``ranking.grouped_discrete_quantile``)."""
    from tidewatch.operators.ranking import grouped_discrete_quantile as gq
    li = bind.read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_returnflag", "l_linenumber", "l_orderkey")
    sup = bind.read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    base = F.floor("l_quantity").cast("long") + F.lit(10)
    travel = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("long")).otherwise(
        base + F.col("l_linenumber") * (F.col("l_orderkey") % 3))
    t = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("s_nationkey").cast("long").alias("area_id"), base.alias("baseline_min"), travel.alias("travel_min"))
    # one row per (area, baseline, travel) -- bounded by the minute domains --
    # written once, so the three measures below share a single line-item scan
    from tidewatch.session import stage_checkpoint
    cnt = stage_checkpoint(t.groupBy("area_id", "baseline_min", "travel_min").agg(F.count(F.lit(1)).alias("_w")),
                           "route_counts")
    w, tr, bl = F.col("_w"), F.col("travel_min"), F.col("baseline_min")
    viable_w = F.when(tr.isNotNull(), w)
    agg = cnt.groupBy("area_id").agg(
        F.sum(w).alias("trips"),
        (F.sum(viable_w.otherwise(0)).cast("double") / F.sum(w) * 100.0).alias("viable_route_share_pct"),
        (F.sum(viable_w * (tr - bl).cast("double") / bl) / F.sum(viable_w) * 100.0).alias("mean_delay_pct"))
    mt = gq(cnt, ["area_id"], "travel_min", 0.5, "median_travel_min", weight="_w")
    mb = gq(cnt, ["area_id"], "baseline_min", 0.5, "median_baseline_min", weight="_w")
    out = agg.join(mt, "area_id", "left").join(mb, "area_id", "left")
    return out.withColumn("delta_travel_min", F.col("median_travel_min") - F.col("median_baseline_min")) \
        .select(*_names(ROUTES))


# ---------------- J-14 / J-15 station selection -----------------

@register("station_selection", sql(out_sql("station_id:l, selection_mode", """(
    WITH cat AS (SELECT DISTINCT station_id FROM tidal_series),
    req AS (SELECT DISTINCT s_suppkey AS station_id FROM supplier),
    exc AS (SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS station_id FROM nation WHERE n_regionkey = 0),
    hit AS (SELECT station_id FROM cat WHERE station_id IN (SELECT station_id FROM req)),
    sel AS (SELECT station_id, 'requested' AS selection_mode FROM hit
            UNION ALL SELECT station_id, 'catalog' FROM cat WHERE NOT EXISTS (SELECT 1 FROM hit))
    SELECT * FROM sel WHERE station_id NOT IN (SELECT station_id FROM exc))"""), "tidal_series"))
def q_selection(spark, sf_dir):
    """J-14 + J-15: requested ids (suppliers) within the catalogue, or the whole
    catalogue when none of them is in it; excluded ids (region-0 nations) go
    afterwards, so excluding every requested station leaves nothing."""
    from tidewatch.operators.catalog import station_selection
    from tidewatch.plans.stations import tidal_series
    cat = tidal_series(spark, sf_dir).select("station_id").distinct()
    req = bind.read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station_id")).distinct()
    exc = (bind.read_table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 0)
           .select(F.col("n_nationkey").cast("long").alias("station_id")).distinct())
    return station_selection(cat, req, exc)


@register("invalid_requested", sql(out_sql("station_id:l", """(
    SELECT DISTINCT s_suppkey AS station_id FROM supplier
    WHERE s_suppkey NOT IN (SELECT station_id FROM tidal_series))"""), "tidal_series"))
def q_invalid(spark, sf_dir):
    """J-15: requested ids that are not in the catalogue (anti join)."""
    from tidewatch.plans.stations import tidal_series
    cat = tidal_series(spark, sf_dir).select("station_id").distinct()
    req = bind.read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station_id")).distinct()
    return req.join(cat, "station_id", "left_anti")


# ---------------- S-14 / A-10 / A-11 / F-11 -----------------

@register("key_violations", sql(out_sql("dataset, key_text, n:l", """(
    SELECT 'events(user_id, ts)' AS dataset, CAST(user_id AS VARCHAR) || '|' || CAST(ts AS VARCHAR) AS key_text,
      count(*) AS n FROM events GROUP BY user_id, ts HAVING count(*) > 1
    UNION ALL SELECT 'orders(o_orderkey)', CAST(o_orderkey AS VARCHAR), count(*) FROM orders
      GROUP BY o_orderkey HAVING count(*) > 1
    UNION ALL SELECT 'lineitem(l_orderkey, l_linenumber)',
      CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")))
def q_keys(spark, sf_dir):
    """S-14: declared source keys that are not unique."""
    from tidewatch.sources.envelopes import key_violations

    def kv(name, table, keys, text):
        d = key_violations(bind.read_table(spark, sf_dir, table), keys)
        return d.select(F.lit(name).alias("dataset"), text.alias("key_text"), F.col("count").alias("n"))
    ts_txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (kv("events(user_id, ts)", "events", ["user_id", "ts"],
               F.concat_ws("|", F.col("user_id").cast("string"), ts_txt))
            .unionByName(kv("orders(o_orderkey)", "orders", ["o_orderkey"], F.col("o_orderkey").cast("string")))
            .unionByName(kv("lineitem(l_orderkey, l_linenumber)", "lineitem", ["l_orderkey", "l_linenumber"],
                            F.concat_ws("|", F.col("l_orderkey").cast("string"),
                                        F.col("l_linenumber").cast("string")))))


@register("quality_value_counts", sql(out_sql("quality, n:l", """(
    SELECT quality, count(*) AS n FROM tidal_series GROUP BY quality)"""), "tidal_series"))
def q_value_counts(spark, sf_dir):
    """A-10: value counts including missing."""
    from tidewatch.plans.stations import tidal_series
    return tidal_series(spark, sf_dir).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@register("document_relevance", sql(out_sql("doc_id:l, source, lang, n_chars:l", """(
    SELECT doc_id, source, lang, n_chars FROM documents
    WHERE source = 'src1' OR regexp_matches(text, '(?i)\\b(flood|storm|warning|puerto rico)\\b'))""")))
def q_documents(spark, sf_dir):
    """F-11 on free text: sender equality or a case-insensitive pattern over the whole text."""
    d = bind.read_table(spark, sf_dir, "documents")
    return al.relevance_filter(d, "source", "src1", ["text"], r"\b(flood|storm|warning|puerto rico)\b") \
        .select("doc_id", "source", "lang", "n_chars")


# ---------------- K-02 GeoJSON features -----------------

@register("geojson_scored", None)
def q_geojson(spark, sf_dir):
    """K-02: one GeoJSON Feature per scored area (rows without coordinates dropped)."""
    from tidewatch.sinks.writers import geojson_features
    s = A.scored_indices(spark, sf_dir).select("area_id", "municipio", "latitude", "longitude", "priority_band",
                                               "priority_index_conf_adj")
    return geojson_features(s)


# ---------------- ST-* streaming (run to completion, read back) -----------------

_H = "(epoch_us({a}) - epoch_us({b})) / 3600000000.0::DOUBLE"


@register("stream_window_stats", sql(out_sql(
    "station_id:l, window_start, window_end, obs_count:l, peak_value:d, mean_value:d", """(
    SELECT station_id, ws AS window_start, ws + INTERVAL 60 MINUTE AS window_end, count(water_level) AS obs_count,
      max(water_level) AS peak_value, avg(water_level) AS mean_value
    FROM (SELECT s.*, time_bucket(INTERVAL 15 MINUTE, time_utc) - k * INTERVAL 15 MINUTE AS ws
          FROM tidal_series s, range(0, 4) t(k))
    GROUP BY station_id, ws)"""), "tidal_series"))
def q_stream_stats(spark, sf_dir):
    """ST-01..ST-03: file stream -> repeated keys dropped -> sliding hourly stats."""
    from tidewatch.streaming.streams import station_window_stats
    d = station_window_stats(spark, sf_dir)
    return d.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
            .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@register("stream_latest_state", sql(out_sql(
    "station_id:l, latest_time_utc, latest_water_level:d, prev_time_utc, prev_water_level:d, rise_rate_per_hour:d",
    f"""(
    SELECT *, CASE WHEN latest_water_level IS NOT NULL AND prev_water_level IS NOT NULL THEN
        (latest_water_level - prev_water_level) /
        greatest({_H.format(a='latest_time_utc', b='prev_time_utc')}, 1e-6::DOUBLE) END AS rise_rate_per_hour
    FROM latest_prev)"""), "latest_prev"))
def q_stream_latest(spark, sf_dir):
    """ST-04: latest / previous reading per station kept across micro-batches."""
    from tidewatch.streaming.streams import latest_state_stream
    d = latest_state_stream(spark, sf_dir)
    for c in ("latest_time_utc", "prev_time_utc"):
        d = d.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return d.select("station_id", "latest_time_utc", "latest_water_level", "prev_time_utc", "prev_water_level",
                    "rise_rate_per_hour")


@register("stream_latest_state_store", ORACLE["stream_latest_state"])
def q_stream_latest_store(spark, sf_dir):
    """ST-04 by Spark's state API (keyed list state) instead of a state table: the same rows."""
    from tidewatch.streaming.stateful import latest_state_by_store
    d = latest_state_by_store(spark, sf_dir)
    for c in ("latest_time_utc", "prev_time_utc"):
        d = d.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return d.select("station_id", "latest_time_utc", "latest_water_level", "prev_time_utc", "prev_water_level",
                    "rise_rate_per_hour")


@register("stream_alert_sessions", sql(out_sql("zone_id, session_start, session_end, n_alerts:l", """(
    SELECT zone_id, min(onset) AS session_start, max(onset) + INTERVAL 24 HOUR AS session_end, count(*) AS n_alerts
    FROM (SELECT *, sum(CASE WHEN prev IS NULL OR onset >= prev + INTERVAL 24 HOUR THEN 1 ELSE 0 END)
                      OVER (PARTITION BY zone_id ORDER BY onset, alert_key ROWS UNBOUNDED PRECEDING) AS sid
          FROM (SELECT a.alert_key, a.onset, z.zone_id,
                  lag(a.onset) OVER (PARTITION BY z.zone_id ORDER BY a.onset, a.alert_key) AS prev
                FROM (SELECT o_orderkey AS alert_key, o_orderdate AS onset FROM orders) a
                JOIN (SELECT DISTINCT alert_key, zone_id FROM alert_zones) z ON a.alert_key = z.alert_key))
    GROUP BY zone_id, sid)"""), "alert_zones"))
def q_stream_sessions(spark, sf_dir):
    """ST-06: alert sessions per zone (24 h gap) from a stream of alerts and a stream of their zones."""
    from tidewatch.streaming.streams import alert_sessions
    d = alert_sessions(spark, sf_dir)
    for c in ("session_start", "session_end"):
        d = d.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return d


@register("stream_scored_indices", _scored_sql("DURING"))
def q_stream_scored(spark, sf_dir):
    """ST-05: the scored indices after the last batch of an event stream, rescored batch by batch from the area state."""
    from tidewatch.streaming.streams import rolling_indices
    return rolling_indices(spark, sf_dir)
