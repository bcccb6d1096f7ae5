"""Area-level plans: census features -> area features -> hazard -> scores -> products.

Each function takes (spark, sf_dir) plus options and returns a DataFrame.  The
stages (municipio risk, area features, station features, area hazard) are
written to the shared checkpoint folder while the plan is built
(``stage_checkpoint``; ``materialize=False`` leaves them out), so later stages
read small tables and do not repeat the station and event scans after an
executor loss.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators import census as cen
from tidewatch.operators import scoring as sc
from tidewatch.operators.alerts import alert_score, global_alert_score
from tidewatch.operators.spatial import area_flood_hazard, area_quake_raw
from tidewatch.plans.stations import station_latest_features
from tidewatch.session import stage_checkpoint
from tidewatch.sources import bind


def municipio_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CENSUS municipio_risk_features: ACS table + rates + min-max scores + risk index."""
    acs = cen.drop_sentinels(bind.acs_municipio(spark, sf_dir))
    acs = acs.withColumn("municipio_key", bind.area_key(F.col("municipio")))
    return cen.add_risk_features(acs)


def zcta_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CENSUS zcta_risk_features: ZCTAs named by any town, then the same features."""
    towns = cen.town_lookup(bind.towns(spark, sf_dir))
    z = cen.drop_sentinels(bind.acs_zcta(spark, sf_dir))
    return cen.add_risk_features(cen.zctas_in_towns(z, towns))


def town_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    towns = cen.town_lookup(bind.towns(spark, sf_dir))
    return cen.town_risk(towns, zcta_risk(spark, sf_dir), municipio_risk(spark, sf_dir))


def area_features(spark: SparkSession, sf_dir: str, income_direction: str = "code",
                  materialize: bool = True) -> DataFrame:
    """P10: municipio risk + centroid -> exposure / vulnerability / resilience.

    The municipio table feeds both the features and the town blend, so it is
    materialized once (a reliable checkpoint in the shared folder).
    """
    muni = municipio_risk(spark, sf_dir)
    if materialize:
        muni = stage_checkpoint(muni)
    towns = cen.town_lookup(bind.towns(spark, sf_dir))
    cent = cen.municipio_centroids(cen.town_risk(towns, zcta_risk(spark, sf_dir), muni))
    base = muni.join(cent, ["municipio_key", "municipio"], "left")
    base = sc.robust_scores(base, [
        ("population", "exposure_population_score", True),
        ("poverty_rate", "poverty_score", True),
        ("no_vehicle_rate", "transport_constraint_score", True),
        ("vacancy_rate", "housing_fragility_score", True),
        ("median_income", "income_capacity_score", False),
    ])
    base = sc.with_area_composites(base, income_direction)
    out = base.select(
        "area_id", "municipio", "municipio_key", "latitude", "longitude",
        "population", "median_income", "poverty_rate", "no_vehicle_rate", "vacancy_rate",
        "exposure_score", "vulnerability_score", "resilience_capacity_score",
        "poverty_score", "transport_constraint_score", "housing_fragility_score", "income_capacity_score",
    )
    return stage_checkpoint(out) if materialize else out


def area_hazard(spark: SparkSession, sf_dir: str, lambda_km: float = C.LAMBDA_KM,
                override_km: float = C.OVERRIDE_KM, areas: DataFrame | None = None,
                materialize: bool = True, stations: DataFrame | None = None) -> DataFrame:
    """P20: flood (weighted / local / alert), earthquake (robust of max intensity), combined.

    Station features are used twice (kernel and latest-observation time), so
    they are materialized once (or handed on as ``stations``); the area table is a
    checkpointed dimension.
    """
    areas = areas if areas is not None else area_features(spark, sf_dir, materialize=materialize)
    areas = areas.select("area_id", "municipio", "municipio_key", "latitude", "longitude")
    g = global_alert_score(alert_score(bind.active_alerts(spark, sf_dir)))
    if stations is None:
        stations = station_latest_features(spark, sf_dir, global_alert=g)
        if materialize:
            stations = stage_checkpoint(stations)
    as_of = bind.series_as_of(spark, sf_dir)
    flood = area_flood_hazard(areas, stations, g, lambda_km, override_km)
    quake = area_quake_raw(areas, bind.earthquakes(spark, sf_dir), as_of)
    haz = flood.join(quake, "area_id", "left")
    haz = sc.robust_score(haz, "earthquake_raw", "earthquake_hazard_score")
    latest_obs = stations.select(F.max("latest_time_utc")).scalar()
    out = (haz.withColumn("earthquake_hazard_score", F.coalesce("earthquake_hazard_score", F.lit(0.0)))
              .withColumn("hazard_combined", F.greatest("flood_hazard_muni", "earthquake_hazard_score"))
              .withColumn("noaa_latest_obs_utc", latest_obs))
    return stage_checkpoint(out) if materialize else out


def scored_indices(spark: SparkSession, sf_dir: str, phase: str = C.DEFAULT_PHASE,
                   materialize: bool = True, as_of: Column | None = None, features: DataFrame | None = None,
                   stations: DataFrame | None = None) -> DataFrame:
    """P30 (flagship): indices, confidence, adjustment toward the median, bands.

    Stage outputs (area features, station features, area hazard) are
    materialized to the checkpoint folder, so the scoring plan reads small
    area tables and an executor loss never replays the event scans.
    ``features`` and ``stations`` hand on area and station features that are already there.
    """
    feats = features if features is not None else area_features(spark, sf_dir, materialize=materialize)
    haz = area_hazard(spark, sf_dir, areas=feats, materialize=materialize, stations=stations)
    h = haz.select("area_id", "flood_hazard_weighted", "flood_hazard_local_max", "nws_global_alert_score",
                   "flood_hazard_muni", "earthquake_raw", "supporting_station_count", "nearby_station_count",
                   "earthquake_hazard_score", "hazard_combined", "noaa_latest_obs_utc")
    df = feats.join(h, "area_id", "inner")
    df = sc.with_operational_indices(df, phase)
    as_of = as_of if as_of is not None else bind.series_as_of(spark, sf_dir)
    df = sc.with_confidence(df, as_of)
    df = sc.with_confidence_adjustment(df)
    df = sc.with_bands(df)
    return df.select("area_id", *sc.SCORED_COLUMNS, "nws_global_alert_score")


def priority_actions(spark: SparkSession, sf_dir: str, phase: str = C.DEFAULT_PHASE,
                     scored: DataFrame | None = None) -> DataFrame:
    """P50: rank by adjusted priority (tie: municipio), recommended actions.

    The rank is a distributed global row number (``ranking``), not a
    single-partition window.
    """
    from tidewatch.operators.ranking import global_row_number
    s = scored if scored is not None else scored_indices(spark, sf_dir, phase)
    s = global_row_number(s, [F.col("priority_index_conf_adj").desc_nulls_last(), F.col("municipio")], "rank")
    s = s.withColumn("recommended_actions", sc.recommended_actions(s))
    return s.select("rank", "municipio", "priority_band", "priority_index_conf_adj", "hazard_combined",
                    "flood_hazard_muni", "earthquake_hazard_score", "vulnerability_score",
                    "response_readiness_index", "recovery_capacity_index", "confidence_score",
                    "recommended_actions")
