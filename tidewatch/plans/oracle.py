"""Independent DuckDB SQL for every registered query.

The SQL is written from the operator definitions, not generated from the
Spark plans.  CTEs are kept in one table (name -> (dependencies, body)) and
``sql(final, *ctes)`` assembles a WITH clause in dependency order.

explicitly, integer outputs are cast to BIGINT, float outputs are rounded to
6 places on both sides, half-even rounding uses ``round_even``.
"""
from __future__ import annotations

from tidewatch import config as C

D = "::DOUBLE"


def _alert_event_sql(event: str, severity: str) -> str:
    parts = [f"WHEN strpos(lower(coalesce({event}, '')), '{n}') > 0 THEN {s}" for n, s in C.ALERT_EVENT_SCORES]
    parts += [f"WHEN lower(coalesce({severity}, '')) = '{n}' THEN {s}" for n, s in C.ALERT_SEVERITY_SCORES.items()]
    return "CASE " + " ".join(parts) + f" ELSE {C.ALERT_DEFAULT_SCORE} END"


def _nl(x: str, lo: float, hi: float) -> str:
    """normalize_linear in SQL."""
    return (f"CASE WHEN {x} IS NOT NULL AND {hi}{D} > {lo}{D} THEN "
            f"{_clip(f'({x} - {lo}{D}) / ({hi}{D} - {lo}{D})', 0.0, 1.0)} * 100.0{D} END")


def _clip(x: str, lo: float = 0.0, hi: float = 100.0) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x}), {lo}{D}), {hi}{D}) END"


def _hours(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier})) / 3600000000.0{D}"


def _band(x: str) -> str:
    parts = " ".join(f"WHEN {x} >= {lo}{D} THEN '{n}'" for n, lo in C.BANDS)
    return f"CASE {parts} ELSE '{C.BAND_ELSE}' END"


def _robust(table: str, col: str, higher_is_worse: bool = True) -> str:
    """Expression for robust_score over a whole table (scalar subqueries)."""
    lo = f"(SELECT quantile_cont({col}, {C.ROBUST_LO_Q}) FROM {table})"
    hi = f"(SELECT quantile_cont({col}, {C.ROBUST_HI_Q}) FROM {table})"
    s = (f"CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {hi} > {lo} THEN "
         f"{_clip(f'({col} - {lo}) / ({hi} - {lo})', 0.0, 1.0)} * 100.0{D} END")
    return s if higher_is_worse else f"(100.0{D} - {s})"


def _minmax(table: str, col: str, invert: bool = False) -> str:
    lo = f"(SELECT min({col}) FROM {table})"
    hi = f"(SELECT max({col}) FROM {table})"
    s = f"CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {hi} <> {lo} THEN ({col} - {lo}) / ({hi} - {lo}) END"
    if invert:
        s = f"(1.0{D} - {s})"
    return _clip(s, 0.0, 1.0)


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(2 * {C.EARTH_RADIUS_KM}{D} * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))")


def _weighted(pairs) -> str:
    return " + ".join(f"{float(w)}{D} * ({x})" for x, w in pairs)


def _meta(sid: str) -> dict[str, str]:
    base_minor = f"(1.0{D} + ({sid} % 5) * 0.5{D})"
    return {
        "station_name": f"'Station ' || CAST({sid} AS VARCHAR)",
        "shefcode": f"'PR' || lpad(CAST({sid} AS VARCHAR), greatest(4, length(CAST({sid} AS VARCHAR)))::INT, '0')",
        "lat": f"17.9{D} + (({sid} * 7) % 60) / 100.0{D}",
        "lon": f"-67.3{D} + (({sid} * 13) % 210) / 100.0{D}",
        "nos_minor": f"CASE WHEN {sid} % 7 = 0 THEN NULL WHEN {sid} % 13 = 0 THEN 0.0{D} ELSE {base_minor} END",
        "action": f"CASE WHEN {sid} % 7 = 0 THEN NULL ELSE 0.8{D} + ({sid} % 4) * 0.5{D} END",
        "nos_moderate": f"2.0{D} + ({sid} % 5) * 0.5{D}",
        "nos_major": (f"CASE WHEN {sid} % 11 = 0 THEN NULL WHEN {sid} % 19 = 0 THEN {base_minor} "
                      f"ELSE 4.0{D} + ({sid} % 5) * 0.5{D} END"),
        "tidal": f"({sid} % 10) <> 9",
    }


def _meta_select(sid: str) -> str:
    m = _meta(sid)
    minor = f"coalesce(CASE WHEN ({m['nos_minor']}) <> 0 THEN ({m['nos_minor']}) END, ({m['action']}))"
    return ", ".join([
        f"{m['station_name']} AS station_name", f"{m['shefcode']} AS shefcode",
        f"{m['lat']} AS lat", f"{m['lon']} AS lon",
        f"{minor} AS minor", f"{m['nos_moderate']} AS moderate", f"{m['nos_major']} AS major",
    ])


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_ZIP = "lpad(CAST(600 + {n} * 4 + {s} AS VARCHAR), 5, '0')"

CTES: dict[str, tuple[list[str], str]] = {
    # ---------------- stations ----------------
    "series": ([], f"""
        SELECT user_id AS station_id, event_id AS obs_id, ts AS time_utc,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 10.0{D} END AS water_level,
               event_type AS quality,
               CAST({_K} % 2 AS VARCHAR) || ',' || CAST({_K} % 3 AS VARCHAR) || ',0,0' AS flags
        FROM events"""),
    "tidal_series": (["series"], f"SELECT * FROM series WHERE {_meta('station_id')['tidal']}"),
    "as_of": ([], "SELECT max(ts) AS as_of FROM events"),
    "top2": (["tidal_series"], """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY time_utc DESC, obs_id DESC) AS rn
          FROM tidal_series) WHERE rn <= 2"""),
    "latest_prev": (["top2"], """
        SELECT l.station_id, l.time_utc AS latest_time_utc, l.water_level AS latest_water_level,
               coalesce(p.time_utc, l.time_utc) AS prev_time_utc,
               CASE WHEN p.station_id IS NULL THEN l.water_level ELSE p.water_level END AS prev_water_level
        FROM top2 l LEFT JOIN top2 p ON p.station_id = l.station_id AND p.rn = 2
        WHERE l.rn = 1"""),
    "alerts": ([], f"""
        SELECT 'urn:alert:' || CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS alert_key,
          CASE WHEN o_orderkey % 100 = 0 THEN 'Flash Flood Warning'
               WHEN o_orderkey % 100 < 5 THEN 'Flood Warning'
               WHEN o_orderkey % 100 < 15 THEN 'Flood Watch'
               WHEN o_orderkey % 100 < 25 THEN 'Flood Advisory'
               WHEN o_orderpriority = '1-URGENT' THEN 'Wind Advisory'
               WHEN o_orderpriority = '2-HIGH' THEN 'Heat Advisory'
               ELSE 'Special Weather Statement' END AS event,
          CASE WHEN o_orderkey % 211 = 0 THEN 'Extreme'
               WHEN o_orderpriority = '1-URGENT' THEN 'Severe'
               WHEN o_orderpriority = '2-HIGH' THEN 'Moderate'
               WHEN o_orderpriority = '3-MEDIUM' THEN 'Minor'
               WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' END AS severity,
          CASE WHEN o_orderstatus = 'F' THEN 'Immediate' ELSE 'Expected' END AS urgency,
          CASE WHEN o_orderstatus = 'P' THEN 'Possible' ELSE 'Likely' END AS certainty,
          o_orderdate AS sent, o_orderdate AS onset, o_orderdate + INTERVAL 3 DAY AS ends,
          'Actual' AS status,
          'Supplier#' || lpad(CAST(o_custkey % (SELECT count(*) FROM supplier) AS VARCHAR), 9, '0') AS area_desc,
          CASE WHEN o_orderkey % 3 = 0 THEN 'NWS San Juan PR' ELSE 'NWS Miami FL' END AS sender_name
        FROM orders"""),
    "alerts_h": (["alerts"], """
        SELECT *, event || ' issued for ' || area_desc AS headline FROM alerts"""),
    "alert_zones": ([], """
        SELECT l_orderkey AS alert_key, 'PRZ' || lpad(CAST(l_suppkey % 13 + 1 AS VARCHAR), 3, '0') AS zone_id
        FROM lineitem"""),
    "scored_alerts": (["alerts_h"], f"SELECT *, {_alert_event_sql('event', 'severity')} AS alert_score FROM alerts_h"),
    "active_alerts": (["scored_alerts"], """
        SELECT * FROM scored_alerts
        WHERE onset <= (SELECT max(o_orderdate) FROM orders) AND ends > (SELECT max(o_orderdate) FROM orders)"""),
    "global_alert": (["active_alerts"],
                     f"SELECT coalesce(CAST(max(alert_score) AS DOUBLE), 0.0{D}) AS g FROM active_alerts"),
    "station_feat0": (["latest_prev"], f"""
        SELECT station_id, {_meta_select('station_id')}, latest_time_utc, latest_water_level,
               prev_time_utc, prev_water_level
        FROM latest_prev"""),
    "station_feat1": (["station_feat0"], f"""
        SELECT *,
          CASE WHEN latest_water_level IS NOT NULL AND prev_water_level IS NOT NULL THEN
            (latest_water_level - prev_water_level) /
            greatest({_hours('latest_time_utc', 'prev_time_utc')}, {C.MIN_DELTA_HOURS}{D}) END AS rise_rate_per_hour,
          CASE WHEN latest_water_level IS NOT NULL AND minor IS NOT NULL AND major IS NOT NULL AND major > minor
            THEN (latest_water_level - minor) / (major - minor) END AS exceed_ratio
        FROM station_feat0"""),
    "station_feat2": (["station_feat1"], f"""
        SELECT *, {_nl('exceed_ratio', *C.EXCEED_BOUNDS)} AS exceed_score,
                  {_nl('rise_rate_per_hour', *C.RISE_BOUNDS)} AS rise_score
        FROM station_feat1"""),
    "station_features": (["station_feat2", "global_alert"], f"""
        SELECT *, greatest({_clip('sensor_hazard_score')}, nws_global_alert_score) AS flood_hazard_final
        FROM (SELECT *,
          coalesce(CASE WHEN exceed_score IS NOT NULL OR rise_score IS NOT NULL THEN
            (coalesce(exceed_score, 0.0{D}) + coalesce(rise_score, 0.0{D})) /
            ((exceed_score IS NOT NULL)::INT + (rise_score IS NOT NULL)::INT) END, 0.0{D}) AS sensor_hazard_score,
          (SELECT g FROM global_alert) AS nws_global_alert_score
        FROM station_feat2)"""),
    # ---------------- earthquakes ----------------
    "quakes": ([], f"""
        SELECT event_id, ts AS time_utc,
          CASE WHEN event_id % 23 = 0 THEN NULL ELSE 1.0{D} + value % 6.0{D} END AS magnitude,
          CASE WHEN event_id % 29 = 0 THEN NULL
               ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) * 2.0{D} END AS depth_km,
          17.0{D} + (event_id % 300) / 100.0{D} AS latitude,
          -68.5{D} + ((event_id * 7) % 500) / 100.0{D} AS longitude,
          'event ' || CAST(event_id AS VARCHAR) AS place, event_type AS status
        FROM events"""),
    # ---------------- census ----------------
    "acs_muni_raw": ([], f"""
        SELECT n.n_nationkey AS area_id, n.n_name AS municipio, a.population,
          CASE WHEN n.n_nationkey % 9 = 4 THEN -666666666.0{D} ELSE a.median_income_raw END AS median_income,
          a.poverty_universe, a.poverty_count, a.housing_units, a.occupied_units, a.vacant_units,
          a.no_vehicle_owner, a.no_vehicle_renter
        FROM nation n LEFT JOIN (
          SELECT c_nationkey, count(*)::DOUBLE AS population, avg(c_acctbal) AS median_income_raw,
            count(*)::DOUBLE AS poverty_universe, count(*) FILTER (WHERE c_acctbal < 1000)::DOUBLE AS poverty_count,
            count(*)::DOUBLE AS housing_units,
            count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD')::DOUBLE AS occupied_units,
            count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD')::DOUBLE AS vacant_units,
            count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE')::DOUBLE AS no_vehicle_owner,
            count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')::DOUBLE AS no_vehicle_renter
          FROM customer GROUP BY c_nationkey) a ON n.n_nationkey = a.c_nationkey"""),
    "acs_zcta_raw": ([], f"""
        SELECT {_ZIP.format(n='c_nationkey', s='c_custkey % 4')} AS zip_code,
            count(*)::DOUBLE AS population, avg(c_acctbal) AS median_income,
            count(*)::DOUBLE AS poverty_universe, count(*) FILTER (WHERE c_acctbal < 1000)::DOUBLE AS poverty_count,
            count(*)::DOUBLE AS housing_units,
            count(*) FILTER (WHERE c_mktsegment <> 'HOUSEHOLD')::DOUBLE AS occupied_units,
            count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD')::DOUBLE AS vacant_units,
            count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE')::DOUBLE AS no_vehicle_owner,
            count(*) FILTER (WHERE c_mktsegment = 'MACHINERY')::DOUBLE AS no_vehicle_renter
        FROM customer GROUP BY 1"""),
    "towns": ([], f"""
        SELECT s.s_name AS designated_area, n.n_name AS municipio,
          CASE WHEN s.s_suppkey % 17 = 16 THEN NULL ELSE 17.95{D} + ((s.s_suppkey * 3) % 50) / 100.0{D} END AS latitude,
          -67.2{D} + ((s.s_suppkey * 11) % 190) / 100.0{D} AS longitude,
          CASE WHEN s.s_suppkey % 10 = 3 THEN NULL
               WHEN s.s_suppkey % 10 = 7 THEN {_ZIP.format(n='s.s_nationkey', s='s.s_suppkey % 4')} || ', ' ||
                    {_ZIP.format(n='s.s_nationkey', s='s.s_suppkey % 4')} || '; 00999'
               ELSE {_ZIP.format(n='s.s_nationkey', s='s.s_suppkey % 4')} || ', ' ||
                    {_ZIP.format(n='s.s_nationkey', s='(s.s_suppkey + 1) % 4')} END AS zip_codes_text
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
}


def _norm_text(x: str) -> str:
    from tidewatch.functions.text import ACCENTED, UNACCENTED
    s = f"translate(regexp_replace(trim({x}), '\\p{{M}}', '', 'g'), '{ACCENTED}', '{UNACCENTED}')"
    s = f"regexp_replace({s}, '[^a-zA-Z0-9\\s]', ' ', 'g')"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    return f"coalesce(trim(lower({s})), '')"


def _sentinel(c: str) -> str:
    codes = ", ".join(f"{float(s)}{D}" for s in C.ACS_SENTINELS)
    return f"CASE WHEN {c} NOT IN ({codes}) THEN {c} END AS {c}"


_ACS = ["population", "median_income", "poverty_universe", "poverty_count", "housing_units",
        "occupied_units", "vacant_units", "no_vehicle_owner", "no_vehicle_renter"]


def _risk_ctes(prefix: str, src: str, keys: str) -> dict[str, tuple[list[str], str]]:
    a, b = f"{prefix}_clean", f"{prefix}_rates"
    scores = {
        "score_population": _minmax(b, "population"),
        "score_poverty": _minmax(b, "poverty_rate"),
        "score_income_vulnerability": _minmax(b, "median_income", invert=True),
        "score_transport_vulnerability": _minmax(b, "no_vehicle_rate"),
        "score_housing_vulnerability": _minmax(b, "vacancy_rate"),
    }
    raw = " + ".join(f"{w}{D} * coalesce({k}, 0.0{D})" for k, w in C.CENSUS_RISK_WEIGHTS.items())
    return {
        a: ([src], f"SELECT {keys}, {', '.join(_sentinel(c) for c in _ACS)} FROM {src}"),
        b: ([a], f"""SELECT *, poverty_count / nullif(poverty_universe, 0) AS poverty_rate,
                 (no_vehicle_owner + no_vehicle_renter) / nullif(occupied_units, 0) AS no_vehicle_rate,
                 vacant_units / nullif(housing_units, 0) AS vacancy_rate FROM {a}"""),
        f"{prefix}_scores": ([b], "SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in scores.items()) + f" FROM {b}"),
        f"{prefix}_risk": ([f"{prefix}_scores"], f"""
            SELECT *, round_even(risk_index_raw * 100.0{D}, 1) AS risk_index
            FROM (SELECT *, {raw} AS risk_index_raw FROM {prefix}_scores)"""),
    }


CTES.update(_risk_ctes("muni", "acs_muni_raw", f"area_id, municipio, {_norm_text('municipio')} AS municipio_key"))
CTES.update({
    "town_lookup": (["towns"], f"""
        SELECT *, {_norm_text('municipio')} AS municipio_key,
          list_sort(list_distinct(regexp_extract_all(coalesce(zip_codes_text, ''), '\\b\\d{{5}}\\b', 0))) AS zip_list
        FROM towns"""),
    "zcta_named": (["acs_zcta_raw", "town_lookup"], """
        SELECT * FROM acs_zcta_raw WHERE zip_code IN (SELECT unnest(zip_list) FROM town_lookup)"""),
})
CTES.update(_risk_ctes("zcta", "zcta_named", "zip_code"))
CTES.update({
    "towns_exploded": (["town_lookup"], """
        SELECT designated_area, municipio, municipio_key, latitude, longitude, z.zip_code
        FROM town_lookup LEFT JOIN LATERAL (SELECT unnest(zip_list) AS zip_code) z ON TRUE"""),
    "town_risk": (["towns_exploded", "zcta_risk", "muni_risk"], f"""
        SELECT t.*, m.risk_index AS municipio_risk_index, m.population AS municipio_population,
          m.median_income AS municipio_median_income, m.poverty_rate AS municipio_poverty_rate,
          m.no_vehicle_rate AS municipio_no_vehicle_rate, m.vacancy_rate AS municipio_vacancy_rate,
          CASE WHEN m.risk_index IS NOT NULL AND t.zip_risk_index IS NOT NULL
                 THEN round_even({C.TOWN_BLEND[0]}{D} * m.risk_index + {C.TOWN_BLEND[1]}{D} * t.zip_risk_index, 1)
               WHEN m.risk_index IS NOT NULL THEN round_even(m.risk_index, 1)
               WHEN t.zip_risk_index IS NOT NULL THEN round_even(t.zip_risk_index, 1) END AS risk_index
        FROM (
          SELECT e.designated_area, e.municipio, e.municipio_key, e.latitude, e.longitude,
            count(DISTINCT e.zip_code) AS zip_count, avg(z.risk_index) AS zip_risk_index,
            coalesce(sum(z.population), 0.0{D}) AS zip_population, avg(z.median_income) AS zip_median_income,
            avg(z.poverty_rate) AS zip_poverty_rate, avg(z.no_vehicle_rate) AS zip_no_vehicle_rate,
            avg(z.vacancy_rate) AS zip_vacancy_rate
          FROM towns_exploded e LEFT JOIN zcta_risk z ON e.zip_code = z.zip_code
          GROUP BY ALL) t
        LEFT JOIN muni_risk m ON t.municipio_key = m.municipio_key"""),
    "centroids": (["town_risk"], """
        SELECT municipio_key, municipio, latitude, longitude FROM (
          SELECT *, row_number() OVER (PARTITION BY municipio_key ORDER BY designated_area ASC NULLS FIRST) AS rn
          FROM town_risk) WHERE rn = 1"""),
    "area_base": (["muni_risk", "centroids"], """
        SELECT m.*, c.latitude, c.longitude FROM muni_risk m
        LEFT JOIN centroids c ON m.municipio_key = c.municipio_key AND m.municipio = c.municipio"""),
    "area_comp": (["area_base"], f"""
        SELECT *,
          {_robust('area_base', 'population')} AS exposure_population_score,
          {_robust('area_base', 'poverty_rate')} AS poverty_score,
          {_robust('area_base', 'no_vehicle_rate')} AS transport_constraint_score,
          {_robust('area_base', 'vacancy_rate')} AS housing_fragility_score,
          {_robust('area_base', 'median_income', higher_is_worse=False)} AS income_capacity_score
        FROM area_base"""),
    "area_features": (["area_comp"], f"""
        SELECT area_id, municipio, municipio_key, latitude, longitude, population, median_income, poverty_rate,
          no_vehicle_rate, vacancy_rate, exposure_population_score AS exposure_score,
          {_weighted([('poverty_score', C.VULNERABILITY_WEIGHTS['poverty']),
                      ('transport_constraint_score', C.VULNERABILITY_WEIGHTS['transport']),
                      ('housing_fragility_score', C.VULNERABILITY_WEIGHTS['housing']),
                      (f'100.0{D} - income_capacity_score', C.VULNERABILITY_WEIGHTS['income_inv'])])}
            AS vulnerability_score,
          {_clip(_weighted([('income_capacity_score', C.RESILIENCE_WEIGHTS['income']),
                            (f'100.0{D} - transport_constraint_score', C.RESILIENCE_WEIGHTS['transport_inv']),
                            (f'100.0{D} - housing_fragility_score', C.RESILIENCE_WEIGHTS['housing_inv'])]))}
            AS resilience_capacity_score,
          poverty_score, transport_constraint_score, housing_fragility_score, income_capacity_score
        FROM area_comp"""),
    # ---------------- hazard ----------------
    "located_areas": (["area_features"],
                      "SELECT * FROM area_features WHERE latitude IS NOT NULL AND longitude IS NOT NULL"),
    "flood_pairs": (["located_areas", "station_features"], f"""
        SELECT a.area_id, s.flood_hazard_final AS h,
          {_haversine('a.latitude', 'a.longitude', 's.lat', 's.lon')} AS d
        FROM located_areas a CROSS JOIN station_features s"""),
    "flood_agg": (["flood_pairs"], f"""
        SELECT area_id, sum(exp(-d / {C.LAMBDA_KM}{D}) * h) / nullif(sum(exp(-d / {C.LAMBDA_KM}{D})), 0)
            AS flood_hazard_weighted,
          max(CASE WHEN d <= {C.OVERRIDE_KM}{D} THEN h END) AS flood_hazard_local_max,
          count(*) AS supporting_station_count,
          count(*) FILTER (WHERE d <= {C.OVERRIDE_KM}{D}) AS nearby_station_count
        FROM flood_pairs GROUP BY area_id"""),
    "quake_agg": (["located_areas", "quakes", "as_of"], f"""
        SELECT a.area_id, max(
          coalesce(q.magnitude, 0.0{D})
          / ln(1 + greatest({_haversine('a.latitude', 'a.longitude', 'q.latitude', 'q.longitude')},
                            {C.EQ_MIN_DIST_KM}{D}))
          * (1.0{D} / (1.0{D} + coalesce(q.depth_km, 0.0{D}) / {C.EQ_DEPTH_SCALE_KM}{D}))
          * exp(-greatest({_hours('(SELECT as_of FROM as_of)', 'q.time_utc')}, 0.0{D}) / {C.EQ_RECENCY_HOURS}{D})
        ) AS earthquake_raw
        FROM located_areas a CROSS JOIN quakes q GROUP BY a.area_id"""),
    "hazard0": (["located_areas", "flood_agg", "quake_agg", "global_alert", "station_features"], f"""
        SELECT a.area_id, a.municipio, a.municipio_key, a.latitude, a.longitude,
          f.flood_hazard_weighted, f.flood_hazard_local_max, (SELECT g FROM global_alert) AS nws_global_alert_score,
          greatest(f.flood_hazard_weighted, f.flood_hazard_local_max, (SELECT g FROM global_alert))
            AS flood_hazard_muni,
          q.earthquake_raw, coalesce(f.supporting_station_count, 0) AS supporting_station_count,
          coalesce(f.nearby_station_count, 0) AS nearby_station_count,
          (SELECT max(latest_time_utc) FROM station_features) AS noaa_latest_obs_utc
        FROM located_areas a LEFT JOIN flood_agg f ON a.area_id = f.area_id
        LEFT JOIN quake_agg q ON a.area_id = q.area_id"""),
    "area_hazard": (["hazard0"], f"""
        SELECT *, greatest(flood_hazard_muni, earthquake_hazard_score) AS hazard_combined FROM (
          SELECT *, coalesce({_robust('hazard0', 'earthquake_raw')}, 0.0{D}) AS earthquake_hazard_score
          FROM hazard0)"""),
})


def _fill(c: str) -> str:
    return f"least(greatest(coalesce({c}, 0.0{D}), 0.0{D}), 100.0{D})"


def _scored_ctes(phase: str) -> dict[str, tuple[list[str], str]]:
    pw = C.PHASE_WEIGHTS[phase]
    rw, cw, w = C.READINESS_WEIGHTS, C.RECOVERY_WEIGHTS, C.CONFIDENCE_WEIGHTS
    age = _hours("(SELECT as_of FROM as_of)", "noaa_latest_obs_utc")
    fresh = _clip(f"100.0{D} - (least(greatest(coalesce({age}, {C.FRESHNESS_HOURS}{D}), 0.0{D}), "
                  f"{C.FRESHNESS_HOURS}{D}) / {C.FRESHNESS_HOURS}{D}) * 100.0{D}")
    compl = ("((hazard_combined IS NOT NULL)::INT + (exposure_score IS NOT NULL)::INT + "
             "(vulnerability_score IS NOT NULL)::INT + (resilience_capacity_score IS NOT NULL)::INT)"
             f"::DOUBLE / 4.0{D} * 100.0{D}")
    valid = (f"CASE WHEN _h BETWEEN 0 AND 100 AND _e BETWEEN 0 AND 100 AND _v BETWEEN 0 AND 100 "
             f"THEN 100.0{D} ELSE 0.0{D} END")
    cross = (f"CASE WHEN coalesce(flood_hazard_muni, 0.0{D}) > 0 OR coalesce(earthquake_hazard_score, 0.0{D}) > 0 "
             f"THEN {C.CROSSCHECK_HIT}{D} ELSE {C.CROSSCHECK_MISS}{D} END")
    hard = (f"coalesce(nws_global_alert_score, 0.0{D}) >= {C.HARD_RED_ALERT}{D} OR "
            f"coalesce(flood_hazard_muni, 0.0{D}) >= {C.HARD_RED_FLOOD}{D}")
    return {
        "sc0": (["area_features", "area_hazard"], f"""
            SELECT f.*, h.flood_hazard_weighted, h.flood_hazard_local_max, h.nws_global_alert_score,
              h.flood_hazard_muni, h.earthquake_raw, h.supporting_station_count, h.nearby_station_count,
              h.earthquake_hazard_score, h.hazard_combined, h.noaa_latest_obs_utc,
              {_fill('h.hazard_combined')} AS _h, {_fill('f.exposure_score')} AS _e,
              {_fill('f.vulnerability_score')} AS _v, {_fill('f.resilience_capacity_score')} AS _r
            FROM area_features f JOIN area_hazard h ON f.area_id = h.area_id"""),
        "sc1": (["sc0"], f"""
            SELECT *, (_h / 100.0{D}) * (_e / 100.0{D}) * (_v / 100.0{D}) * 100.0{D} AS risk_index_raw,
              _r AS resilience_index,
              {_clip(_weighted([(f'100.0{D} - _h', rw['hazard_inv']), ('_r', rw['resilience']),
                                (f'100.0{D} - _v', rw['vulnerability_inv'])]))} AS response_readiness_index,
              {_clip(_weighted([('_r', cw['resilience']), (f'100.0{D} - _e', cw['exposure_inv']),
                                (f'100.0{D} - _v', cw['vulnerability_inv'])]))} AS recovery_capacity_index
            FROM sc0"""),
        "sc2": (["sc1", "as_of"], f"""
            SELECT *, {_clip(_weighted([('risk_index_raw', pw['risk']),
                                        (f'100.0{D} - response_readiness_index', pw['rr']),
                                        (f'100.0{D} - recovery_capacity_index', pw['rc'])]))} AS priority_index,
              {_clip(_weighted([(fresh, w['freshness']), (compl, w['completeness']), (valid, w['validity']),
                                (cross, w['crosscheck'])]))} AS confidence_score
            FROM sc1"""),
        "sc3": (["sc2"], f"""
            SELECT *, confidence_0_1 * priority_index + (1.0{D} - confidence_0_1) *
                      (SELECT median(priority_index) FROM sc2) AS priority_index_conf_adj
            FROM (SELECT *, {_clip(f'confidence_score / 100.0{D}', 0.0, 1.0)} AS confidence_0_1 FROM sc2)"""),
        "scored": (["sc3"], f"""
            SELECT *, CASE WHEN {hard} THEN 'Red' ELSE {_band('priority_index_conf_adj')} END AS priority_band,
              '{phase}' AS phase
            FROM sc3"""),
    }


def ctes_for(phase: str = C.DEFAULT_PHASE) -> dict[str, tuple[list[str], str]]:
    out = dict(CTES)
    out.update(_scored_ctes(phase))
    out.update(EXTRA_CTES)
    return out


EXTRA_CTES: dict[str, tuple[list[str], str]] = {}


def sql(final: str, *roots: str, phase: str = C.DEFAULT_PHASE) -> str:
    """Assemble ``WITH <ctes needed by roots> <final>``."""
    table = ctes_for(phase)
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str):
        if n in seen:
            return
        seen.add(n)
        deps, _ = table[n]
        for d in deps:
            visit(d)
        order.append(n)

    for r in roots:
        visit(r)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({table[n][1]})" for n in order)
    return f"WITH {body}\n{final}"
