"""Registered queries for the coded stages (stations, alerts, census, areas, scores)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import alerts as al
from tidewatch.plans import areas as A
from tidewatch.plans import stations as S
from tidewatch.plans.oracle import sql
from tidewatch.plans.registry import out_sql, register
from tidewatch.sources import bind

STATION_LATEST = ("station_id:l, station_name, shefcode, lat:d, lon:d, latest_time_utc, latest_water_level:d, "
                  "rise_rate_per_hour:d, minor:d, moderate:d, major:d, exceed_ratio:d, exceed_score:d, "
                  "rise_score:d, sensor_hazard_score:d, nws_global_alert_score:d, flood_hazard_final:d")


@register("station_latest_features", sql(out_sql(STATION_LATEST, "station_features"), "station_features"))
def q_station_latest(spark, sf_dir):
    return S.station_latest_features(spark, sf_dir)


STATION_SUMMARY = ("station_id:l, station_name, latest_time_utc, latest_value:d, latest_quality, lat:d, lon:d, "
                   "minor:d, moderate:d, major:d, obs_count:l, peak_value:d, mean_value:d")


@register("station_summary", sql(out_sql(STATION_SUMMARY, """(
    SELECT l.station_id, f.station_name, l.time_utc AS latest_time_utc, l.water_level AS latest_value,
      l.quality AS latest_quality, f.lat, f.lon, f.minor, f.moderate, f.major,
      a.obs_count, a.peak_value, a.mean_value
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY time_utc DESC, obs_id DESC) rn
                         FROM tidal_series) WHERE rn = 1) l
    JOIN (SELECT station_id, count(water_level) AS obs_count, max(water_level) AS peak_value,
                 avg(water_level) AS mean_value FROM tidal_series GROUP BY station_id) a USING (station_id)
    JOIN station_feat0 f USING (station_id))"""), "tidal_series", "station_feat0"))
def q_station_summary(spark, sf_dir):
    return S.station_summary(spark, sf_dir)


ALERTS_ENRICHED = ("id, event, severity, urgency, certainty, headline, sent, onset, ends, status, area_desc, "
                   "ugc_list, alert_score:l")


@register("alerts_enriched", sql(out_sql(ALERTS_ENRICHED, """(
    SELECT a.*, coalesce(z.ugc_list, '') AS ugc_list FROM scored_alerts a
    LEFT JOIN (SELECT alert_key, array_to_string(list_sort(list_distinct(list(zone_id))), ',') AS ugc_list
               FROM alert_zones GROUP BY alert_key) z USING (alert_key))"""), "scored_alerts", "alert_zones"))
def q_alerts_enriched(spark, sf_dir):
    e = al.alerts_enriched(bind.alerts(spark, sf_dir), bind.alert_zones(spark, sf_dir))
    return e.select(*[c.split(":")[0].strip() for c in ALERTS_ENRICHED.split(",")])


QUAKES = "event_id:l, time_utc, magnitude:d, depth_km:d, latitude:d, longitude:d, place, status"


@register("earthquake_events", sql(out_sql(QUAKES, "quakes", where="magnitude >= 1.0"), "quakes"))
def q_quakes(spark, sf_dir):
    """S-07 binding + F-10 minimum magnitude (the feed's default 1.0), latest first."""
    q = bind.earthquakes(spark, sf_dir)
    return q.filter(F.col("magnitude") >= 1.0).orderBy(F.col("time_utc").desc(), F.col("event_id"))


MUNI_RISK = ("area_id:l, municipio, municipio_key, population:d, median_income:d, poverty_universe:d, "
             "poverty_count:d, housing_units:d, occupied_units:d, vacant_units:d, no_vehicle_owner:d, "
             "no_vehicle_renter:d, poverty_rate:d, no_vehicle_rate:d, vacancy_rate:d, score_population:d, "
             "score_poverty:d, score_income_vulnerability:d, score_transport_vulnerability:d, "
             "score_housing_vulnerability:d, risk_index_raw:d, risk_index:d")


def _names(spec: str) -> list[str]:
    return [c.split(":")[0].strip() for c in spec.split(",")]


@register("municipio_risk_features", sql(out_sql(MUNI_RISK, "muni_risk"), "muni_risk"))
def q_muni_risk(spark, sf_dir):
    return A.municipio_risk(spark, sf_dir).select(*_names(MUNI_RISK))


ZCTA_RISK = MUNI_RISK.replace("area_id:l, municipio, municipio_key", "zip_code")


@register("zcta_risk_features", sql(out_sql(ZCTA_RISK, "zcta_risk"), "zcta_risk"))
def q_zcta_risk(spark, sf_dir):
    return A.zcta_risk(spark, sf_dir).select(*_names(ZCTA_RISK))


TOWN_RISK = ("designated_area, municipio, municipio_key, latitude:d, longitude:d, zip_count:l, zip_risk_index:d, "
             "zip_population:d, zip_median_income:d, zip_poverty_rate:d, zip_no_vehicle_rate:d, zip_vacancy_rate:d, "
             "municipio_risk_index:d, municipio_population:d, municipio_median_income:d, municipio_poverty_rate:d, "
             "municipio_no_vehicle_rate:d, municipio_vacancy_rate:d, risk_index:d")


@register("town_risk_features", sql(out_sql(TOWN_RISK, "town_risk"), "town_risk"))
def q_town_risk(spark, sf_dir):
    return A.town_risk(spark, sf_dir).select(*_names(TOWN_RISK))


AREA_FEATURES = ("area_id:l, municipio, municipio_key, latitude:d, longitude:d, population:d, median_income:d, "
                 "poverty_rate:d, no_vehicle_rate:d, vacancy_rate:d, exposure_score:d, vulnerability_score:d, "
                 "resilience_capacity_score:d, poverty_score:d, transport_constraint_score:d, "
                 "housing_fragility_score:d, income_capacity_score:d")


@register("area_features", sql(out_sql(AREA_FEATURES, "area_features"), "area_features"))
def q_area_features(spark, sf_dir):
    return A.area_features(spark, sf_dir)


AREA_HAZARD = ("area_id:l, municipio, municipio_key, latitude:d, longitude:d, flood_hazard_weighted:d, "
               "flood_hazard_local_max:d, nws_global_alert_score:d, flood_hazard_muni:d, earthquake_raw:d, "
               "supporting_station_count:l, nearby_station_count:l, earthquake_hazard_score:d, hazard_combined:d, "
               "noaa_latest_obs_utc")


@register("area_hazard", sql(out_sql(AREA_HAZARD, "area_hazard"), "area_hazard"))
def q_area_hazard(spark, sf_dir):
    return A.area_hazard(spark, sf_dir).select(*_names(AREA_HAZARD))


SCORED = ("area_id:l, municipio, municipio_key, latitude:d, longitude:d, hazard_combined:d, flood_hazard_muni:d, "
          "earthquake_hazard_score:d, exposure_score:d, vulnerability_score:d, resilience_index:d, "
          "response_readiness_index:d, recovery_capacity_index:d, risk_index_raw:d, priority_index:d, "
          "priority_index_conf_adj:d, confidence_score:d, confidence_0_1:d, priority_band, phase, "
          "nws_global_alert_score:d")


def _scored_sql(phase: str) -> str:
    return sql(out_sql(SCORED, "scored"), "scored", phase=phase)


def _ordered(scored):
    """D-30 / L-01: the scored product's order."""
    return scored.orderBy(F.col("priority_index_conf_adj").desc_nulls_last(), F.col("municipio"))


@register("scored_indices", _scored_sql("DURING"))
def q_scored(spark, sf_dir):
    return _ordered(A.scored_indices(spark, sf_dir, "DURING"))


@register("scored_indices_pre", _scored_sql("PRE"))
def q_scored_pre(spark, sf_dir):
    return _ordered(A.scored_indices(spark, sf_dir, "PRE"))


@register("scored_indices_post", _scored_sql("POST"))
def q_scored_post(spark, sf_dir):
    return _ordered(A.scored_indices(spark, sf_dir, "POST"))


def _actions_sql() -> str:
    from tidewatch import config as C
    items = ", ".join(
        f"CASE WHEN {col} {op} {thr}::DOUBLE THEN '{text}' END" for col, op, thr, text in C.ACTION_RULES)
    # list_filter keeps rule order; the rule texts are distinct, so no de-duplication is needed
    acts = f"list_filter([{items}], lambda x: x IS NOT NULL)"
    return (f"CASE WHEN len({acts}) > 0 THEN array_to_string({acts}, '{C.ACTION_SEPARATOR}') "
            f"ELSE '{C.ACTION_DEFAULT}' END")


PRIORITY = ("rank:l, municipio, priority_band, priority_index_conf_adj:d, hazard_combined:d, flood_hazard_muni:d, "
            "earthquake_hazard_score:d, vulnerability_score:d, response_readiness_index:d, recovery_capacity_index:d, "
            "confidence_score:d, recommended_actions")


@register("priority_actions", sql(out_sql(PRIORITY, f"""(
    SELECT *, row_number() OVER (ORDER BY priority_index_conf_adj DESC NULLS LAST, municipio) AS rank,
      {_actions_sql()} AS recommended_actions
    FROM scored)"""), "scored"))
def q_priority(spark, sf_dir):
    return A.priority_actions(spark, sf_dir)
