"""Registered queries of the replays (SP-04 per zone and step, SP-28 indices per area and step)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.plans import oracle as O
from tidewatch.plans import replay as R
from tidewatch.plans.oracle import D, sql
from tidewatch.plans.registry import out_sql, register
from tidewatch.sources import bind

_RUN = "(SELECT max(o_orderdate) FROM orders)"


@register("zone_alert_timeline", sql(out_sql("zone_id, step_utc, zone_alert_score:l, n_active:l", f"""(
    SELECT z.zone_id, s.t AS step_utc, coalesce(max(a.alert_score), 0) AS zone_alert_score, count(a.alert_key) AS n_active
    FROM (SELECT DISTINCT zone_id FROM alert_zones) z
    CROSS JOIN (SELECT {_RUN} - k * INTERVAL 24 HOUR AS t
                FROM range(0, 1 + (SELECT date_diff('day', min(o_orderdate), max(o_orderdate)) FROM orders)) r(k)) s
    LEFT JOIN (SELECT DISTINCT x.alert_key, y.zone_id, x.alert_score, x.onset, x.ends
               FROM scored_alerts x JOIN alert_zones y ON x.alert_key = y.alert_key) a
      ON a.zone_id = z.zone_id AND a.onset <= s.t AND s.t < a.ends
    GROUP BY z.zone_id, s.t)"""), "scored_alerts", "alert_zones"))
def q_zone_timeline(spark, sf_dir):
    """SP-04: alert score of every zone at every day of the alert feed."""
    as_of = bind.read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return R.zone_alert_timeline(bind.alerts(spark, sf_dir), bind.alert_zones(spark, sf_dir), as_of)


REPLAY = ("area_id:l, municipio, step_utc, nws_global_alert_score:d, flood_hazard_muni:d, earthquake_raw:d, earthquake_hazard_score:d, "
          "hazard_combined:d, risk_index_raw:d, response_readiness_index:d, recovery_capacity_index:d, priority_index:d, "
          "confidence_score:d, priority_index_conf_adj:d, priority_band")


def _replay_sql() -> str:
    """The batch formulas with every step's own as-of rows."""
    h, cw, rw, pw, qw = O._haversine, C.CONFIDENCE_WEIGHTS, C.READINESS_WEIGHTS, C.PHASE_WEIGHTS[C.DEFAULT_PHASE], C.RECOVERY_WEIGHTS
    fresh = O._clip(f"100.0{D} - least(greatest(coalesce({O._hours('t', 'seen')}, {C.FRESHNESS_HOURS}{D}), 0.0{D}), {C.FRESHNESS_HOURS}{D}) "
                    f"/ {C.FRESHNESS_HOURS}{D} * 100.0{D}")
    whole = " + ".join(f"({c} IS NOT NULL)::INT" for c in ("hazard_combined", "exposure_score", "vulnerability_score", "resilience_capacity_score"))
    cross = (f"CASE WHEN coalesce(flood_hazard_muni, 0.0{D}) > 0 OR earthquake_hazard_score > 0 THEN {C.CROSSCHECK_HIT}{D} "
             f"ELSE {C.CROSSCHECK_MISS}{D} END")
    body = f"""
    steps AS MATERIALIZED (
      SELECT -k AS step, (SELECT max(ts) FROM events) - k * INTERVAL 24 HOUR AS t, {_RUN} - k * INTERVAL 24 HOUR AS a
      FROM range(0, 1 + (SELECT ((epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000) FROM events)) r(k)),
    g AS MATERIALIZED (
      SELECT step, coalesce(max(x.alert_score), 0)::DOUBLE AS g FROM steps LEFT JOIN scored_alerts x ON x.onset <= a AND x.ends > a GROUP BY step),
    top AS (
      SELECT s.step, x.*, row_number() OVER (PARTITION BY s.step, x.station_id ORDER BY x.time_utc DESC, x.obs_id DESC) AS rn
      FROM steps s JOIN tidal_series x ON x.time_utc <= s.t QUALIFY rn <= 2),
    st0 AS (
      SELECT l.step, l.station_id, {O._meta_select('l.station_id')}, l.time_utc AS latest_time_utc, l.water_level AS v,
        CASE WHEN l.water_level IS NOT NULL AND (CASE WHEN p.step IS NULL THEN l.water_level ELSE p.water_level END) IS NOT NULL THEN
          (l.water_level - (CASE WHEN p.step IS NULL THEN l.water_level ELSE p.water_level END))
          / greatest({O._hours('l.time_utc', 'coalesce(p.time_utc, l.time_utc)')}, {C.MIN_DELTA_HOURS}{D}) END AS rise
      FROM top l LEFT JOIN top p ON p.step = l.step AND p.station_id = l.station_id AND p.rn = 2 WHERE l.rn = 1),
    st AS MATERIALIZED (
      SELECT *, greatest({O._clip('sensor')}, g) AS h FROM (
        SELECT y.*, g.g, coalesce((coalesce(es, 0) + coalesce(rs, 0)) / nullif((es IS NOT NULL)::INT + (rs IS NOT NULL)::INT, 0), 0.0{D}) AS sensor
        FROM (SELECT z.*, {O._nl('ratio', *C.EXCEED_BOUNDS)} AS es, {O._nl('rise', *C.RISE_BOUNDS)} AS rs
              FROM (SELECT *, CASE WHEN v IS NOT NULL AND major > minor THEN (v - minor) / (major - minor) END AS ratio FROM st0) z) y
        JOIN g ON g.step = y.step)),
    fl AS (
      SELECT area_id, step, sum(exp(-d / {C.LAMBDA_KM}{D}) * h) / sum(exp(-d / {C.LAMBDA_KM}{D})) AS weighted,
        max(CASE WHEN d <= {C.OVERRIDE_KM}{D} THEN h END) AS near
      FROM (SELECT a.area_id, st.step, st.h, {h('a.latitude', 'a.longitude', 'st.lat', 'st.lon')} AS d FROM located_areas a, st) GROUP BY ALL),
    qd AS MATERIALIZED (
      SELECT a.area_id, q.time_utc, coalesce(q.magnitude, 0.0{D}) / (1.0{D} + coalesce(q.depth_km, 0.0{D}) / {C.EQ_DEPTH_SCALE_KM}{D})
        / ln(1 + greatest({h('a.latitude', 'a.longitude', 'q.latitude', 'q.longitude')}, {C.EQ_MIN_DIST_KM}{D})) AS f
      FROM located_areas a, quakes q),
    qk AS (
      SELECT area_id, step, max(f * exp(-{O._hours('t', 'time_utc')} / {C.EQ_RECENCY_HOURS}{D})) AS raw
      FROM steps JOIN qd ON time_utc <= t GROUP BY ALL),
    h0 AS MATERIALIZED (
      SELECT a.*, s.step, s.t, g.g AS nws_global_alert_score, greatest(fl.weighted, fl.near, g.g) AS flood_hazard_muni, qk.raw AS earthquake_raw,
        (SELECT max(latest_time_utc) FROM st WHERE st.step = s.step) AS seen
      FROM located_areas a CROSS JOIN steps s JOIN g ON g.step = s.step
      LEFT JOIN fl ON fl.area_id = a.area_id AND fl.step = s.step LEFT JOIN qk ON qk.area_id = a.area_id AND qk.step = s.step),
    qs AS (SELECT step, quantile_cont(earthquake_raw, {C.ROBUST_LO_Q}) AS lo, quantile_cont(earthquake_raw, {C.ROBUST_HI_Q}) AS hi FROM h0 GROUP BY step),
    h1 AS (
      SELECT *, greatest(flood_hazard_muni, earthquake_hazard_score) AS hazard_combined FROM (
        SELECT h0.*, coalesce(CASE WHEN hi > lo THEN {O._clip('(earthquake_raw - lo) / (hi - lo)', 0.0, 1.0)} * 100.0{D} END, 0.0{D}) AS earthquake_hazard_score
        FROM h0 JOIN qs ON qs.step = h0.step)),
    h2 AS (SELECT *, {O._fill('hazard_combined')} AS _h, {O._fill('exposure_score')} AS _e, {O._fill('vulnerability_score')} AS _v,
             {O._fill('resilience_capacity_score')} AS _r FROM h1),
    h3 AS (
      SELECT *, _h / 100.0{D} * _e / 100.0{D} * _v AS risk_index_raw,
        {O._clip(O._weighted([(f'100.0{D} - _h', rw['hazard_inv']), ('_r', rw['resilience']), (f'100.0{D} - _v', rw['vulnerability_inv'])]))} AS response_readiness_index,
        {O._clip(O._weighted([('_r', qw['resilience']), (f'100.0{D} - _e', qw['exposure_inv']), (f'100.0{D} - _v', qw['vulnerability_inv'])]))} AS recovery_capacity_index
      FROM h2),
    h4 AS MATERIALIZED (
      SELECT *, {O._clip(O._weighted([('risk_index_raw', pw['risk']), (f'100.0{D} - response_readiness_index', pw['rr']),
                                      (f'100.0{D} - recovery_capacity_index', pw['rc'])]))} AS priority_index,
        {O._clip(O._weighted([(fresh, cw['freshness']), (f'({whole})::DOUBLE / 4.0{D} * 100.0{D}', cw['completeness']), (f'100.0{D}', cw['validity']),
                              (cross, cw['crosscheck'])]))} AS confidence_score
      FROM h3),
    h5 AS (
      SELECT h4.*, m.med * (1.0{D} - confidence_score / 100.0{D}) + priority_index * confidence_score / 100.0{D} AS priority_index_conf_adj
      FROM h4 JOIN (SELECT step, median(priority_index) AS med FROM h4 GROUP BY step) m ON m.step = h4.step)"""
    final = out_sql(REPLAY, f"""(
      SELECT *, t AS step_utc, CASE WHEN nws_global_alert_score >= {C.HARD_RED_ALERT}{D} OR coalesce(flood_hazard_muni, 0.0{D}) >= {C.HARD_RED_FLOOD}{D}
        THEN 'Red' ELSE {O._band('priority_index_conf_adj')} END AS priority_band FROM h5)""")
    return sql(final, "scored_alerts", "tidal_series", "located_areas", "quakes").replace("\n" + final, "," + body + "\n" + final)


@register("indices_replay", _replay_sql())
def q_indices_replay(spark, sf_dir):
    """SP-28: the scored indices of every area at every day of the readings."""
    return R.indices_by_step(spark, sf_dir)
