"""Registered queries for validation, spec-declared operators and products."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators import validation as V
from tidewatch.plans import areas as A
from tidewatch.plans import oracle as _O
from tidewatch.plans.oracle import sql
from tidewatch.plans.registry import out_sql, register
from tidewatch.sources import bind

EXTRA = {
    "outcomes": ([], """
        SELECT CAST(doc_id % (SELECT count(*) FROM nation) AS BIGINT) AS area_id, CAST(sum(toxic) AS BIGINT) AS impact_count,
               CAST(max(toxic) AS BIGINT) AS impact_observed
        FROM labels GROUP BY 1"""),
    "scored_outcomes": (["scored", "outcomes"], """
        SELECT s.*, o.impact_count, o.impact_observed FROM scored s LEFT JOIN outcomes o ON s.area_id = o.area_id"""),
}


EXTRA["af"] = (["scored", "area_features"], """
    SELECT s.area_id, s.priority_band, f.population, f.vulnerability_score
    FROM scored s JOIN area_features f ON s.area_id = f.area_id""")


_O.EXTRA_CTES.update(EXTRA)

_MASK30 = "((area_id * 37 + 11) % 100) < 30"


@register("validation_metrics", sql(out_sql("metric, value:d", f"""(
    SELECT 'row_count' AS metric, count(*)::DOUBLE AS value FROM scored
    UNION ALL SELECT 'null_rate_priority_index_conf_adj', avg((priority_index_conf_adj IS NULL)::INT::DOUBLE) FROM scored
    UNION ALL SELECT 'priority_min', min(priority_index_conf_adj) FROM scored
    UNION ALL SELECT 'priority_max', max(priority_index_conf_adj) FROM scored
    UNION ALL SELECT 'priority_mean', avg(priority_index_conf_adj) FROM scored
    UNION ALL SELECT 'band_count_' || coalesce(priority_band, 'nan'), count(*)::DOUBLE FROM scored GROUP BY priority_band
    UNION ALL SELECT 'stress_test_mae_priority',
      avg(abs(priority_index_conf_adj - CASE WHEN {_MASK30}
          THEN (SELECT median(priority_index_conf_adj) FROM scored WHERE {_MASK30}) ELSE priority_index_conf_adj END))
      FROM scored)"""), "scored"))
def q_validation(spark, sf_dir):
    return V.index_metrics(A.scored_indices(spark, sf_dir))


def _with_outcomes(spark, sf_dir):
    s = A.scored_indices(spark, sf_dir)
    return s.join(bind.area_outcomes(spark, sf_dir), "area_id", "left")


def _avg_rank(col: str) -> str:
    return f"(rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0::DOUBLE)"


@register("spearman_backtest", sql(out_sql("spearman_rank_corr:d, n:l", f"""(
    SELECT corr(ra, rb) AS spearman_rank_corr, count(*) AS n FROM (
      SELECT {_avg_rank('priority_index_conf_adj')} AS ra, {_avg_rank('impact_count')} AS rb
      FROM scored_outcomes WHERE priority_index_conf_adj IS NOT NULL AND impact_count IS NOT NULL))"""),
    "scored_outcomes"))
def q_spearman(spark, sf_dir):
    return V.spearman(_with_outcomes(spark, sf_dir), "priority_index_conf_adj", "impact_count")


@register("red_band_precision_recall", sql(out_sql(
    "true_positive:l, false_escalation:l, missed:l, precision:d, recall:d", """(
    SELECT *, true_positive::DOUBLE / nullif(true_positive + false_escalation, 0) AS precision,
              true_positive::DOUBLE / nullif(true_positive + missed, 0) AS recall
    FROM (SELECT count(*) FILTER (WHERE priority_band = 'Red' AND coalesce(impact_observed = 1, false)) AS true_positive,
                 count(*) FILTER (WHERE priority_band = 'Red' AND NOT coalesce(impact_observed = 1, false))
                   AS false_escalation,
                 count(*) FILTER (WHERE priority_band <> 'Red' AND coalesce(impact_observed = 1, false)) AS missed
          FROM scored_outcomes))"""), "scored_outcomes"))
def q_precision(spark, sf_dir):
    return V.red_band_precision_recall(_with_outcomes(spark, sf_dir))


@register("fairness_by_quartile", sql(out_sql(
    "vulnerability_quartile:l, areas:l, red_count:l, red_share:d, population_share:d", """(
    SELECT q AS vulnerability_quartile, count(*) AS areas, count(*) FILTER (WHERE priority_band = 'Red') AS red_count,
      (count(*) FILTER (WHERE priority_band = 'Red'))::DOUBLE / count(*) AS red_share,
      sum(population) / (SELECT sum(population) FROM af) AS population_share
    FROM (SELECT *, ntile(4) OVER (ORDER BY vulnerability_score ASC NULLS FIRST, area_id) AS q FROM af)
    GROUP BY q)"""), "af"))
def q_fairness(spark, sf_dir):
    feats = A.area_features(spark, sf_dir)
    s = A.scored_indices(spark, sf_dir, features=feats).drop("vulnerability_score")
    return V.fairness_by_quartile(s.join(feats.select("area_id", "population", "vulnerability_score"), "area_id"))


def _sens_sql() -> str:
    base = C.PHASE_WEIGHTS[C.DEFAULT_PHASE]
    rows = []
    for comp in ("risk", "rr", "rc"):
        for dlt in C.SPEC_SENSITIVITY_DELTAS:
            w = dict(base)
            w[comp] = w[comp] * (1 + dlt)
            tot = sum(w.values())
            rows.append(f"('{comp}', {float(dlt)}::DOUBLE, {w['risk'] / tot!r}::DOUBLE, "
                        f"{w['rr'] / tot!r}::DOUBLE, {w['rc'] / tot!r}::DOUBLE)")
    scen = f"(VALUES {', '.join(rows)}) AS sc(component, delta, w_risk, w_rr, w_rc)"
    p_new = ("CASE WHEN x IS NOT NULL THEN least(greatest(x, 0.0::DOUBLE), 100.0::DOUBLE) END")
    inner = ("risk_index_raw * w_risk + (100.0::DOUBLE - response_readiness_index) * w_rr"
             " + (100.0::DOUBLE - recovery_capacity_index) * w_rc")
    return f"""(
    SELECT component, delta, corr(rb::DOUBLE, rn::DOUBLE) AS spearman_rank_corr, max(abs(rb - rn)) AS max_rank_shift
    FROM (SELECT *, row_number() OVER (PARTITION BY component, delta ORDER BY priority_index DESC, area_id) AS rb,
                    row_number() OVER (PARTITION BY component, delta ORDER BY p_new DESC, area_id) AS rn
          FROM (SELECT s.area_id, s.priority_index, sc.component, sc.delta,
                       {p_new.replace('x', '(' + inner + ')')} AS p_new
                FROM scored s, {scen}))
    GROUP BY component, delta)"""


@register("weight_sensitivity", sql(out_sql("component, delta:d, spearman_rank_corr:d, max_rank_shift:l",
                                            _sens_sql()), "scored"))
def q_sensitivity(spark, sf_dir):
    return V.weight_sensitivity(A.scored_indices(spark, sf_dir))


def _dropout_sql() -> str:
    """SP-23 oracle: the scoring CTEs re-run on a per-level copy of the inputs
    whose hazard is removed for the masked areas."""
    sc = _O._scored_ctes(C.DEFAULT_PHASE)
    D = _O.D
    levels = ", ".join(f"({x}{D})" for x in C.SPEC_DROPOUT_LEVELS)
    mask = "((s.area_id * 37 + 11) % 100 + 100) % 100 < CAST(round(lv.level * 100) AS INTEGER)"
    _O.EXTRA_CTES["dl0"] = (["sc0"], f"""
        SELECT s.* REPLACE (CASE WHEN {mask} THEN NULL ELSE s.hazard_combined END AS hazard_combined,
                            CASE WHEN {mask} THEN 0.0{D} ELSE s._h END AS _h),
               lv.level, {mask} AS masked
        FROM sc0 s CROSS JOIN (VALUES {levels}) lv(level)""")
    _O.EXTRA_CTES["dl1"] = (["dl0"], sc["sc1"][1].replace("FROM sc0", "FROM dl0"))
    _O.EXTRA_CTES["dl2"] = (["dl1", "as_of"], sc["sc2"][1].replace("FROM sc1", "FROM dl1"))
    return sql(out_sql("level:d, mae_priority:d, dropped_areas:l", f"""(
        WITH m AS (SELECT level, median(priority_index) AS _med FROM dl2 GROUP BY level),
        a AS (SELECT d.area_id, d.level, d.masked,
                {_O._clip(f'd.confidence_score / 100.0{D}', 0.0, 1.0)} * d.priority_index
                + (1.0{D} - {_O._clip(f'd.confidence_score / 100.0{D}', 0.0, 1.0)}) * m._med AS adj
              FROM dl2 d JOIN m ON d.level = m.level)
        SELECT a.level, avg(abs(a.adj - s.priority_index_conf_adj)) AS mae_priority,
          count(*) FILTER (WHERE a.masked) AS dropped_areas
        FROM a JOIN scored s ON a.area_id = s.area_id GROUP BY a.level)"""), "dl2", "scored")


@register("dropout_stability", _dropout_sql())
def q_dropout(spark, sf_dir):
    """SP-23: hazard dropped for 20 / 30 / 40 % of areas, indices and
    confidence recomputed, MAE of the adjusted priority against the full run."""
    feats = A.area_features(spark, sf_dir)
    haz = A.area_hazard(spark, sf_dir, areas=feats)
    h = haz.select("area_id", "nws_global_alert_score", "flood_hazard_muni", "earthquake_hazard_score",
                   "hazard_combined", "noaa_latest_obs_utc")
    return V.dropout_stability(feats.join(h, "area_id"), bind.series_as_of(spark, sf_dir))




# ---------------------------------------------------------------------------
# SP-06 .. SP-09, SP-20: generic composites over the long indicator table
# ---------------------------------------------------------------------------

def _meta_values() -> str:
    def lit(v):
        return "NULL::DOUBLE" if v is None else f"{float(v)}::DOUBLE"
    rows = [f"('{i}', '{x}', {w}::DOUBLE, '{d}', '{p}', {lit(lo)}, {lit(hi)})"
            for i, x, w, d, p, lo, hi in bind.indicator_meta_rows()]
    return f"(VALUES {', '.join(rows)}) AS m(indicator, idx, w, direction, policy, lo, hi)"


_ICS_COLS = {
    "hospitals": "avg(l_discount)", "power": "avg(l_tax)", "water": "avg(l_quantity)",
    "roads_bridges": "avg((l_returnflag = 'R')::INT::DOUBLE) * 100.0::DOUBLE",
    "telecom": "avg((l_linestatus = 'O')::INT::DOUBLE) * 100.0::DOUBLE",
    "ports": "avg(l_extendedprice)", "airports": "count(*)::DOUBLE", "emergency_facilities": "sum(l_quantity)",
}
_RR_COLS = {
    "route_reliability": "avg((o_orderstatus = 'F')::INT::DOUBLE) * 100.0::DOUBLE",
    "resource_proximity": "avg(o_totalprice) / 1000.0::DOUBLE",
    "comms_reach": "avg((o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT::DOUBLE) * 100.0::DOUBLE",
    "eoc_staffing_flag": "max((o_orderpriority = '1-URGENT')::INT::DOUBLE)",
    "utility_restoration_velocity": "avg(o_totalprice) / 10000.0::DOUBLE",
    "healthcare_access_restoration": "avg(c_acctbal) / 100.0::DOUBLE",
    "school_reopening_pct": "avg((o_orderstatus <> 'P')::INT::DOUBLE) * 100.0::DOUBLE",
    "housing_habitability_proxy": "avg((c_mktsegment = 'HOUSEHOLD')::INT::DOUBLE) * 100.0::DOUBLE",
}


def _long_sql(cols: dict[str, str], src: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({key} AS BIGINT) AS area_id, '{n}' AS indicator, {e} AS value FROM {src} GROUP BY {key}"
        for n, e in cols.items())


_O.EXTRA_CTES.update({
    "indicators": ([], _long_sql(_ICS_COLS, "lineitem JOIN supplier ON l_suppkey = s_suppkey", "s_nationkey")
                   + " UNION ALL "
                   + _long_sql(_RR_COLS, "orders JOIN customer ON o_custkey = c_custkey", "c_nationkey")),
    "ind_scored": (["indicators"], f"""
        SELECT i.area_id, i.indicator, m.idx AS "index", m.w, i.value,
          CASE WHEN m.direction = 'higher_better' THEN 100.0::DOUBLE - s ELSE s END AS score
        FROM (SELECT i.*, CASE WHEN i.value IS NOT NULL AND b_lo IS NOT NULL AND b_hi IS NOT NULL AND b_hi > b_lo
                THEN least(greatest((i.value - b_lo) / (b_hi - b_lo), 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE END AS s
              FROM (SELECT i.*, CASE WHEN m.policy IN ('thresholds', 'percentiles') AND p.p_lo IS NOT NULL
                                     THEN p.p_lo ELSE m.lo END AS b_lo,
                              CASE WHEN m.policy IN ('thresholds', 'percentiles') AND p.p_lo IS NOT NULL
                                     THEN p.p_hi ELSE m.hi END AS b_hi
                    FROM indicators i JOIN {_meta_values()} ON i.indicator = m.indicator
                    LEFT JOIN (SELECT indicator, quantile_cont(value, 0.05) AS p_lo, quantile_cont(value, 0.95) AS p_hi
                               FROM indicators GROUP BY indicator) p ON i.indicator = p.indicator) i) i
        JOIN {_meta_values()} ON i.indicator = m.indicator"""),
})


def _spec_long(spark, sf_dir):
    from tidewatch.operators import composite as CO
    meta = CO.indicator_meta(spark, bind.indicator_meta_rows())
    return CO.normalise_indicators(bind.area_indicators(spark, sf_dir), meta)


@register("spec_composite_indices", sql(out_sql(
    'area_id:l, "index", weighted_sum:d, weight_present:d, index_value:d', """(
    SELECT area_id, "index", sum(w * score) AS weighted_sum, sum(CASE WHEN score IS NOT NULL THEN w END) AS weight_present,
      100.0::DOUBLE - sum(w * score) AS index_value
    FROM ind_scored GROUP BY area_id, "index")"""), "ind_scored"))
def q_spec_composite(spark, sf_dir):
    from tidewatch.operators import composite as CO
    return CO.composite(_spec_long(spark, sf_dir), invert=("ics", "readiness", "recovery"))


@register("spec_top_drivers", sql(out_sql(
    'area_id:l, "index", driver_rank:l, indicator, contribution:d', """(
    SELECT * FROM (SELECT area_id, "index", indicator, w * score AS contribution,
        row_number() OVER (PARTITION BY area_id, "index" ORDER BY w * score DESC, indicator) AS driver_rank
      FROM ind_scored WHERE score IS NOT NULL) WHERE driver_rank <= 3)"""), "ind_scored"))
def q_spec_drivers(spark, sf_dir):
    from tidewatch.operators import composite as CO
    return CO.top_drivers(_spec_long(spark, sf_dir), 3)


def _pw(k):
    return f"{C.PHASE_WEIGHTS[C.DEFAULT_PHASE][k]}::DOUBLE"


_PD_SQL = f"""(
    SELECT area_id, driver_rank, indicator, contribution,
      CASE WHEN confidence_score >= 80 THEN 'high' WHEN confidence_score >= 60 THEN 'medium' ELSE 'low' END
        AS confidence_tier
    FROM (SELECT *, row_number() OVER (PARTITION BY area_id ORDER BY contribution DESC, indicator) AS driver_rank
          FROM (SELECT area_id, confidence_score, 'risk_index_raw' AS indicator,
                       risk_index_raw * {_pw('risk')} AS contribution FROM scored
                UNION ALL SELECT area_id, confidence_score, 'response_readiness_gap',
                       (100.0::DOUBLE - response_readiness_index) * {_pw('rr')} FROM scored
                UNION ALL SELECT area_id, confidence_score, 'recovery_capacity_gap',
                       (100.0::DOUBLE - recovery_capacity_index) * {_pw('rc')} FROM scored))
    WHERE driver_rank <= 3)"""


@register("priority_drivers", sql(out_sql(
    "area_id:l, driver_rank:l, indicator, contribution:d, confidence_tier", _PD_SQL), "scored"))
def q_priority_drivers(spark, sf_dir):
    from tidewatch.operators import composite as CO
    return CO.priority_drivers(A.scored_indices(spark, sf_dir))


def _wr(phase):
    w = C.SPEC_RISK_PHASE_WEIGHTS[phase]
    f = "least(greatest(coalesce({}, 0.0::DOUBLE), 0.0::DOUBLE), 100.0::DOUBLE)"
    return (f"{w['hazard']}::DOUBLE * {f.format('hazard_combined')} + {w['exposure']}::DOUBLE * "
            f"{f.format('exposure_score')} + {w['vulnerability']}::DOUBLE * {f.format('vulnerability_score')}")


@register("weighted_risk_by_phase", sql(out_sql("area_id:l, phase, risk_weighted:d", f"""(
    SELECT area_id, 'PRE' AS phase, {_wr('PRE')} AS risk_weighted FROM scored
    UNION ALL SELECT area_id, 'DURING', {_wr('DURING')} FROM scored)"""), "scored"))
def q_weighted_risk(spark, sf_dir):
    """SP-05: spec H/E/V weights per phase profile."""
    from tidewatch.operators import composite as CO
    s = A.scored_indices(spark, sf_dir)
    outs = [CO.weighted_risk(s, p).select("area_id", F.lit(p).alias("phase"), "risk_weighted")
            for p in C.SPEC_RISK_PHASE_WEIGHTS]
    return outs[0].unionByName(outs[1])


# ---------------------------------------------------------------------------
# Station-level spec operators
# ---------------------------------------------------------------------------

def _series(spark, sf_dir):
    from tidewatch.plans.stations import tidal_series
    return tidal_series(spark, sf_dir)


def _meta_fn(df):
    from tidewatch.plans.stations import with_station_meta
    return with_station_meta(df)


_H = "(epoch_us({a}) - epoch_us({b})) / 3600000000.0::DOUBLE"

_O.EXTRA_CTES.update({
    "latest_row": (["tidal_series"], """
        SELECT station_id, time_utc AS latest_time_utc, obs_id AS latest_obs_id, water_level AS latest_water_level
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY time_utc DESC, obs_id DESC) AS rn
              FROM tidal_series) WHERE rn = 1"""),
    "window_rise": (["latest_row", "tidal_series"], f"""
        SELECT l.station_id, l.latest_time_utc, l.latest_water_level, f.time_utc AS window_start_utc,
          CASE WHEN l.latest_water_level IS NOT NULL AND f.water_level IS NOT NULL THEN
            (l.latest_water_level - f.water_level) /
            greatest({_H.format(a='l.latest_time_utc', b='f.time_utc')}, 1e-6::DOUBLE) END AS rise_rate_window
        FROM latest_row l JOIN (
          SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.station_id ORDER BY s.time_utc, s.obs_id) AS rn
                         FROM tidal_series s JOIN latest_row l2 ON s.station_id = l2.station_id
                         WHERE s.time_utc >= l2.latest_time_utc - INTERVAL 60 MINUTE
                           AND s.time_utc <= l2.latest_time_utc) WHERE rn = 1) f
        ON l.station_id = f.station_id"""),
    "wr_meta": (["window_rise"], f"""
        SELECT w.*, {_O._meta_select('w.station_id')} FROM window_rise w"""),
})


def _clipq(x, lo, hi):
    return (f"CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {hi} > {lo} AND {x} IS NOT NULL THEN "
            f"least(greatest(({x} - {lo}) / ({hi} - {lo}), 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE END")


def _q(tbl, col, q):
    return f"(SELECT quantile_cont({col}, {q}) FROM {tbl})"


SPEC_STATION = ("station_id:l, latest_time_utc, latest_water_level:d, window_start_utc, rise_rate_window:d, "
                "minor:d, major:d, exceedance_ratio:d, exceedance_score:d, rise_score:d, station_hazard_spec:d")


@register("spec_station_hazard", sql(out_sql(SPEC_STATION, f"""(
    SELECT *, 0.6::DOUBLE * coalesce(exceedance_score, 0.0::DOUBLE) + 0.4::DOUBLE * coalesce(rise_score, 0.0::DOUBLE)
      AS station_hazard_spec
    FROM (SELECT *, CASE WHEN minor IS NOT NULL AND major IS NOT NULL AND major > minor
                         THEN CASE WHEN exceedance_ratio IS NOT NULL THEN
                                least(greatest(exceedance_ratio, 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE END
                         ELSE {_clipq('latest_water_level', _q('wr_meta', 'latest_water_level', 0.05),
                                      _q('wr_meta', 'latest_water_level', 0.95))} END AS exceedance_score,
                 {_clipq('rise_rate_window', _q('wr_meta', 'rise_rate_window', 0.05),
                         _q('wr_meta', 'rise_rate_window', 0.95))} AS rise_score
          FROM (SELECT *, CASE WHEN minor IS NOT NULL AND major IS NOT NULL AND major > minor
                                 AND latest_water_level IS NOT NULL
                               THEN (latest_water_level - minor) / (major - minor) END AS exceedance_ratio
                FROM wr_meta)))"""), "wr_meta"))
def q_spec_station(spark, sf_dir):
    from tidewatch.operators.quality import spec_station_hazard
    return spec_station_hazard(_series(spark, sf_dir), _meta_fn).select(*[c.split(":")[0].strip()
                                                                          for c in SPEC_STATION.split(",")])


@register("gauge_hazard", sql(out_sql(
    "station_id:l, latest_water_level:d, rise_rate_per_hour:d, gauge_height_score:d, flow_change_score:d, "
    "gauge_hazard:d", f"""(
    SELECT *, 0.5::DOUBLE * gauge_height_score + 0.5::DOUBLE * flow_change_score AS gauge_hazard
    FROM (SELECT station_id, latest_water_level, rise_rate_per_hour,
            {_clipq('latest_water_level', _q('station_features', 'latest_water_level', 0.05),
                    _q('station_features', 'latest_water_level', 0.95))} AS gauge_height_score,
            {_clipq('rise_rate_per_hour', _q('station_features', 'rise_rate_per_hour', 0.05),
                    _q('station_features', 'rise_rate_per_hour', 0.95))} AS flow_change_score
          FROM station_features))"""), "station_features"))
def q_gauge(spark, sf_dir):
    """SP-03 on the station latest table."""
    from tidewatch.operators.quality import gauge_hazard
    from tidewatch.plans.stations import station_latest_features
    s = station_latest_features(spark, sf_dir).select("station_id", "latest_water_level", "rise_rate_per_hour")
    return gauge_hazard(s)


_O.EXTRA_CTES["bf0"] = (["latest_row", "tidal_series"], """
    SELECT l.station_id, l.latest_time_utc, l.latest_water_level, g.water_level AS last_good_value
    FROM latest_row l LEFT JOIN (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY time_utc DESC, obs_id DESC) rn
                     FROM tidal_series WHERE water_level IS NOT NULL) WHERE rn = 1) g
    ON l.station_id = g.station_id""")


@register("baseline_fallback", sql(out_sql(
    "station_id:l, latest_time_utc, latest_water_level:d, last_good_value:d, value_filled:d, fill_source", """(
    SELECT *, coalesce(latest_water_level, last_good_value, (SELECT median(last_good_value) FROM bf0)) AS value_filled,
      CASE WHEN latest_water_level IS NOT NULL THEN 'latest' WHEN last_good_value IS NOT NULL THEN 'last_good'
           ELSE 'baseline_median' END AS fill_source
    FROM bf0)"""), "bf0"))
def q_fallback(spark, sf_dir):
    """SP-13: latest, else last good value, else median of stations' last good values."""
    from tidewatch.operators.quality import baseline_fallback
    return baseline_fallback(_series(spark, sf_dir)).drop("latest_obs_id")




@register("baseline_percentiles", None)
def q_baseline_pct(spark, sf_dir):
    """SP-14 (approximate sketch per station; checked against exact values in tests)."""
    from tidewatch.operators.quality import baseline_percentiles
    return baseline_percentiles(_series(spark, sf_dir), bind.series_as_of(spark, sf_dir))


@register("baseline_percentiles_exact", sql(out_sql("station_id:l, baseline_p05:d, baseline_p95:d, n_values:l", f"""(
    SELECT station_id, quantile_cont(u, {C.ROBUST_LO_Q}) AS baseline_p05,
      quantile_cont(u, {C.ROBUST_HI_Q}) AS baseline_p95, count(u) AS n_values
    FROM (SELECT station_id, water_level AS u FROM tidal_series
          WHERE time_utc >= (SELECT as_of FROM as_of) - INTERVAL {C.SPEC_BASELINE_WINDOW_DAYS} DAY
            AND time_utc <= (SELECT as_of FROM as_of))
    GROUP BY station_id HAVING count(u) > 0)"""), "tidal_series", "as_of"))
def q_baseline_pct_exact(spark, sf_dir):
    """SP-14 exact, skew-safe."""
    from tidewatch.operators.quality import baseline_percentiles_exact
    return baseline_percentiles_exact(_series(spark, sf_dir), bind.series_as_of(spark, sf_dir))


_DAY = "epoch_us(time_utc) // 86400000000"
_W = C.SPEC_BASELINE_WINDOW_DAYS


@register("baseline_rolling_exact", sql(out_sql("station_id:l, day:l, baseline_p05:d, baseline_p95:d, n_values:l", f"""(
    SELECT t.station_id, t.day, quantile_cont(s.water_level, {C.ROBUST_LO_Q}) AS baseline_p05,
      quantile_cont(s.water_level, {C.ROBUST_HI_Q}) AS baseline_p95, count(*) AS n_values
    FROM (SELECT DISTINCT station_id, {_DAY} AS day FROM tidal_series WHERE water_level IS NOT NULL) t
    JOIN tidal_series s ON s.station_id = t.station_id AND s.water_level IS NOT NULL AND {_DAY} BETWEEN t.day - {_W - 1} AND t.day
    GROUP BY ALL)"""), "tidal_series"))
def q_rolling_exact(spark, sf_dir):
    """SP-14: p05 / p95 over the trailing 365 days per station and day, exact."""
    from tidewatch.operators.quality import rolling_baseline_exact
    return rolling_baseline_exact(_series(spark, sf_dir))


@register("baseline_rolling", sql(out_sql("station_id:l, day:l, n_values:l, p05_in_bound, p95_in_bound", f"""(
    SELECT t.station_id, t.day, count(*) AS n_values, true AS p05_in_bound, true AS p95_in_bound
    FROM (SELECT DISTINCT station_id, {_DAY} AS day FROM tidal_series WHERE water_level IS NOT NULL) t
    JOIN tidal_series s ON s.station_id = t.station_id AND s.water_level IS NOT NULL AND {_DAY} BETWEEN t.day - {_W - 1} AND t.day
    GROUP BY ALL)"""), "tidal_series"))
def q_rolling(spark, sf_dir):
    """SP-14: the same from one stored sketch per station and day, each value held against its exact rank."""
    from tidewatch.operators.quality import rolling_baseline_checked
    return rolling_baseline_checked(_series(spark, sf_dir))


QUALITY = ("station_id:l, latest_time_utc, n_obs:l, n_recent:l, n_recent_missing:l, n_out_of_range:l, n_flagged:l, "
           "freshness_hours:d, missing_rate:d, out_of_range_rate:d, flagged_rate:d, freshness_factor:d, completeness_factor:d, "
           "validity_factor:d, neighbour_agreement:d, alert_agreement:d, crosscheck_factor:d, quality_score:d")


@register("observation_quality", sql(out_sql(QUALITY, f"""(
    WITH g AS (SELECT station_id, max(time_utc) AS latest_time_utc, arg_max(struct_pack(v := water_level), (time_utc, obs_id)).v AS level,
          count(*) AS n_obs, count(*) FILTER (WHERE time_utc >= (SELECT as_of FROM as_of) - INTERVAL 24 HOUR) AS n_recent,
          count(*) FILTER (WHERE time_utc >= (SELECT as_of FROM as_of) - INTERVAL 24 HOUR AND water_level IS NULL) AS n_recent_missing,
          count(*) FILTER (WHERE water_level IS NOT NULL AND (water_level < 0 OR water_level > 45)) AS n_out_of_range,
          count(*) FILTER (WHERE coalesce(TRY_CAST(trim(split_part(flags, ',', 1)) AS INTEGER), 0) <> 0) AS n_flagged
        FROM tidal_series GROUP BY station_id),
    r AS (SELECT *, {_H.format(a='(SELECT as_of FROM as_of)', b='latest_time_utc')} AS freshness_hours,
        n_recent_missing::DOUBLE / nullif(n_recent, 0) AS missing_rate, n_out_of_range::DOUBLE / n_obs AS out_of_range_rate,
        n_flagged::DOUBLE / n_obs AS flagged_rate
      FROM g),
    p AS (SELECT station_id, level, {_O._meta('station_id')['lat']} AS la, {_O._meta('station_id')['lon']} AS lo FROM g WHERE level IS NOT NULL),
    x AS (SELECT s.station_id, avg(o.level) AS others FROM p s JOIN p o ON o.station_id <> s.station_id
          AND {_O._haversine('s.la', 's.lo', 'o.la', 'o.lo')} <= {C.OVERRIDE_KM}::DOUBLE GROUP BY s.station_id),
    m AS (SELECT station_id, minor FROM station_feat0),
    k AS (SELECT count(*) > 0 AS alert FROM active_alerts WHERE event IN ('Flood Watch', 'Flood Warning', 'Flash Flood Warning')),
    n AS (SELECT r.*, least(greatest(1.0::DOUBLE - abs(level - others) / 45.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS na,
            CASE WHEN level IS NOT NULL AND minor IS NOT NULL THEN ((level >= minor) = (SELECT alert FROM k))::INT::DOUBLE END AS alert_agreement, others
          FROM r LEFT JOIN x ON x.station_id = r.station_id LEFT JOIN m ON m.station_id = r.station_id),
    o AS (SELECT *, CASE WHEN others IS NOT NULL AND level IS NOT NULL THEN na END AS neighbour_agreement FROM n),
    f AS (SELECT *, least(greatest(1.0::DOUBLE - freshness_hours / 168.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS freshness_factor,
        1.0::DOUBLE - coalesce(missing_rate, 1.0::DOUBLE) AS completeness_factor,
        (1.0::DOUBLE - out_of_range_rate) * (1.0::DOUBLE - flagged_rate) AS validity_factor,
        coalesce((coalesce(neighbour_agreement, 0) + coalesce(alert_agreement, 0))
          / nullif((neighbour_agreement IS NOT NULL)::INT + (alert_agreement IS NOT NULL)::INT, 0), 1.0::DOUBLE) AS crosscheck_factor
      FROM o)
    SELECT *, 100.0::DOUBLE * (0.35::DOUBLE * freshness_factor + 0.25::DOUBLE * completeness_factor + 0.25::DOUBLE * validity_factor
      + 0.15::DOUBLE * crosscheck_factor) AS quality_score FROM f)"""), "tidal_series", "as_of", "station_feat0", "active_alerts"))
def q_quality(spark, sf_dir):
    """SP-16: freshness, completeness, validity and cross-check (nearby stations, alert state) with the spec's weights."""
    from tidewatch.operators.quality import observation_quality
    named = [e for events in C.SPEC_PHASE_EVENTS.values() for e in events]
    active = bind.active_alerts(spark, sf_dir).filter(F.col("event").isin(named)).select(F.count(F.lit(1)) > 0).scalar()
    d = observation_quality(_series(spark, sf_dir), bind.series_as_of(spark, sf_dir), _meta_fn, active)
    return d.select(*[c.split(":")[0].strip() for c in QUALITY.split(",")])


_O.EXTRA_CTES["series_prev"] = (["tidal_series"], """
    SELECT *, lag(time_utc) OVER w AS prev_time_utc, lag(obs_id) OVER w AS prev_obs_id,
              lag(water_level) OVER w AS prev_water_level
    FROM tidal_series WINDOW w AS (PARTITION BY station_id ORDER BY time_utc, obs_id)""")


@register("station_gaps", sql(out_sql(
    "station_id:l, time_utc, obs_id:l, prev_time_utc, gap_seconds:d, kind", f"""(
    SELECT * FROM (SELECT station_id, time_utc, obs_id, prev_time_utc,
        (epoch_us(time_utc) - epoch_us(prev_time_utc)) / 1000000.0::DOUBLE AS gap_seconds,
        CASE WHEN epoch_us(time_utc) = epoch_us(prev_time_utc) THEN 'duplicate'
             WHEN epoch_us(time_utc) - epoch_us(prev_time_utc) > 43200000000 THEN 'gap' END AS kind
      FROM series_prev) WHERE kind IS NOT NULL
    UNION ALL
    SELECT station_id, time_utc, obs_id, top AS prev_time_utc, (epoch_us(time_utc) - epoch_us(top)) / 1000000.0::DOUBLE AS gap_seconds, 'out_of_order' AS kind
    FROM (SELECT *, max(time_utc) OVER (PARTITION BY station_id ORDER BY obs_id + CASE WHEN obs_id % 53 = 0 THEN 700 ELSE 0 END, obs_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM tidal_series)
    WHERE top > time_utc)"""), "series_prev", "tidal_series"))
def q_gaps(spark, sf_dir):
    """SP-17: gaps longer than 2 x 6 h cadence, duplicate timestamps, readings that arrive out of order
    (edge rows: every 53rd reading arrives 700 events late)."""
    from tidewatch.operators.timeseries import gaps
    arrival = F.col("obs_id") + F.when(F.col("obs_id") % 53 == 0, F.lit(700)).otherwise(F.lit(0))
    return gaps(_series(spark, sf_dir).withColumn("arrival", arrival), cadence_minutes=360.0, factor=2.0, arrival_col="arrival")


@register("station_rates", sql(out_sql(
    "station_id:l, time_utc, obs_id:l, water_level:d, prev_time_utc, prev_water_level:d, rate_per_hour:d", f"""(
    SELECT station_id, time_utc, obs_id, water_level, prev_time_utc, prev_water_level,
      CASE WHEN water_level IS NOT NULL AND prev_water_level IS NOT NULL THEN (water_level - prev_water_level) /
        greatest({_H.format(a='time_utc', b='prev_time_utc')}, 1e-6::DOUBLE) END AS rate_per_hour
    FROM series_prev)"""), "series_prev"))
def q_rates(spark, sf_dir):
    """W-04: rate of change against the previous reading, every row of the series."""
    from tidewatch.operators.timeseries import per_row_rate
    r = per_row_rate(_series(spark, sf_dir))
    return r.select("station_id", "time_utc", "obs_id", "water_level", "prev_time_utc", "prev_water_level",
                    "rate_per_hour")


@register("station_outliers", sql(out_sql(
    "station_id:l, obs_id:l, time_utc, water_level:d, z_score:d, is_outlier", """(
    SELECT s.station_id, s.obs_id, s.time_utc, s.water_level, (s.water_level - st.mu) / nullif(st.sd, 0) AS z_score,
      coalesce(abs((s.water_level - st.mu) / nullif(st.sd, 0)) > 3.0, false)
        OR coalesce(s.water_level < 0.0 OR s.water_level > 45.0, false) AS is_outlier
    FROM tidal_series s LEFT JOIN (SELECT station_id, avg(water_level) AS mu, stddev_samp(water_level) AS sd
                                   FROM tidal_series GROUP BY station_id) st ON s.station_id = st.station_id)"""),
    "tidal_series"))
def q_outliers(spark, sf_dir):
    """SP-18: z-score (|z| > 3) and plausibility range [0, 45]."""
    from tidewatch.operators.timeseries import outliers
    o = outliers(_series(spark, sf_dir), z=3.0, lo=0.0, hi=45.0)
    return o.select("station_id", "obs_id", "time_utc", "water_level", "z_score", "is_outlier")


@register("station_trend", sql(out_sql("station_id:l, slope_per_hour:d, n_points:l", """(
    SELECT station_id, regr_slope(water_level, epoch_us(time_utc) / 3600000000.0::DOUBLE) AS slope_per_hour,
      regr_count(water_level, epoch_us(time_utc) / 3600000000.0::DOUBLE) AS n_points
    FROM tidal_series GROUP BY station_id)"""), "tidal_series"))
def q_trend(spark, sf_dir):
    """SP-19: least-squares slope per station."""
    from tidewatch.operators.timeseries import trend
    return trend(_series(spark, sf_dir))


@register("lookback_window", sql(out_sql(
    "station_id:l, obs_id:l, time_utc, water_level:d, quality, flags", """(
    SELECT * FROM tidal_series
    WHERE time_utc >= (SELECT as_of FROM as_of) - INTERVAL 72 HOUR AND time_utc <= (SELECT as_of FROM as_of))"""),
    "tidal_series", "as_of"))
def q_lookback(spark, sf_dir):
    """F-09: the 72 h lookback window ending at the run time."""
    from tidewatch.operators.timeseries import lookback
    return lookback(_series(spark, sf_dir), bind.series_as_of(spark, sf_dir), C.LOOKBACK_HOURS)


_O.EXTRA_CTES["rp_grid"] = (["tidal_series"], """
    SELECT st.station_id, unnest(range(r.lo, r.hi + 86400, 86400)) AS step_epoch
    FROM (SELECT DISTINCT station_id FROM tidal_series) st,
         (SELECT min(CAST(ceil(epoch(time_utc) / 86400.0) * 86400 AS BIGINT)) AS lo,
                 max(CAST(ceil(epoch(time_utc) / 86400.0) * 86400 AS BIGINT)) AS hi FROM tidal_series) r""")


@register("historical_replay", sql(out_sql(
    "station_id:l, step_utc, latest_time_utc, latest_water_level:d, minor:d, major:d, exceed_score:d", f"""(
    SELECT g.station_id, make_timestamp(g.step_epoch * 1000000) AS step_utc, a.time_utc AS latest_time_utc,
      a.water_level AS latest_water_level, m.minor, m.major,
      {_O._nl('CASE WHEN m.minor IS NOT NULL AND m.major IS NOT NULL AND m.major > m.minor AND a.water_level IS NOT NULL THEN (a.water_level - m.minor) / (m.major - m.minor) END', 0.0, 1.0)} AS exceed_score
    FROM rp_grid g
    JOIN LATERAL (SELECT * FROM tidal_series s WHERE s.station_id = g.station_id
                  AND epoch(s.time_utc) <= g.step_epoch ORDER BY s.time_utc DESC, s.obs_id DESC LIMIT 1) a ON TRUE
    JOIN (SELECT station_id, minor, major FROM station_feat0) m ON m.station_id = g.station_id)"""),
    "rp_grid", "station_feat0"))
def q_replay(spark, sf_dir):
    """SP-28: as-of latest reading and exceedance score per station and daily step."""
    from tidewatch.operators.quality import replay_latest
    r = replay_latest(_series(spark, sf_dir), _meta_fn, step_hours=24)
    return r.select("station_id", "step_utc", "latest_time_utc", "latest_water_level", "minor", "major",
                    "exceed_score")


