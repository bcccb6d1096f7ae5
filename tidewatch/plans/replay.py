"""Replay plans: indices at every step (SP-28), alert scores per zone and step (SP-04).

Each feed is replayed against its own run time: step -k stands k steps before the
latest reading for readings and earthquakes, and k steps before the latest onset
for alerts, as the batch pipeline takes each feed's latest time for its run.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.numeric import clip
from tidewatch.operators import replay as rp
from tidewatch.operators import scoring as sc
from tidewatch.operators import timeseries as ts
from tidewatch.operators.alerts import alert_score
from tidewatch.plans.areas import area_features
from tidewatch.plans.stations import tidal_series, with_station_meta
from tidewatch.session import stage_checkpoint
from tidewatch.sources import bind

STEP_HOURS = 24.0
#: Columns of an area that do not change over a replay.
STILL = ["area_id", "municipio", "exposure_score", "vulnerability_score", "resilience_capacity_score"]


def alert_intervals(alerts: DataFrame, as_of: Column, step_hours: float = STEP_HOURS) -> DataFrame:
    """Scored alerts with the first step of their time and the first one after it."""
    return alert_score(alerts).select("alert_key", F.col("alert_score").cast("long").alias("alert_score"),
                                      rp.step_of(F.col("onset"), as_of, step_hours).alias("begin"),
                                      rp.step_of(F.col("ends"), as_of, step_hours).alias("end"))


def zone_alert_timeline(alerts: DataFrame, zones: DataFrame, as_of: Column, step_hours: float = STEP_HOURS) -> DataFrame:
    """SP-04 per zone and step: the largest score of the alerts in force, and their number.

    ``zones``: (alert_key, zone_id).  A zone has every step from the first onset of any
    alert to the run time; where nothing is in force the score is 0.
    """
    a = alert_intervals(alerts, as_of, step_hours)
    lo = a.select(F.min(F.when(F.col("end").isNull() | (F.col("end") > F.col("begin")), F.col("begin")))).scalar()
    per = a.join(zones.select("alert_key", "zone_id").distinct(), "alert_key")
    line = rp.level_timeline(per, ["zone_id"], lo, level="alert_score")
    grid = zones.select("zone_id").distinct().select("zone_id", rp.steps_from(lo).alias("step"))
    out = grid.join(line, ["zone_id", "step"], "left")
    return out.select("zone_id", rp.step_time("step", as_of, step_hours).cast("timestamp_ntz").alias("step_utc"),
                      F.coalesce("alert_score", F.lit(0)).alias("zone_alert_score"), F.coalesce("n_active", F.lit(0)).alias("n_active"))


def indices_by_step(spark: SparkSession, sf_dir: str, phase: str = C.DEFAULT_PHASE, step_hours: float = STEP_HOURS) -> DataFrame:
    """SP-28: hazard, indices, priority and band of every area at every step.

    A step's row equals the batch pipeline's at that time (``scored_indices``).  Raw
    readings, events and alerts are each read once, whatever the number of steps.
    """
    feats = area_features(spark, sf_dir)
    areas = feats.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    as_of, alerts_as_of = bind.series_as_of(spark, sf_dir), bind.read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    events = bind.read_table(spark, sf_dir, "events")
    lo = events.select(F.min(rp.step_of(F.col("ts"), as_of, step_hours))).scalar()

    alerts = rp.level_timeline(alert_intervals(bind.alerts(spark, sf_dir), alerts_as_of, step_hours), [], lo, level="alert_score")
    steps = spark.range(1).select(rp.steps_from(lo).alias("step"))
    override = stage_checkpoint(steps.join(alerts, "step", "left").select(
        "step", F.coalesce(F.col("alert_score").cast("double"), F.lit(0.0)).alias("nws_global_alert_score")), "replay_alerts")

    series = tidal_series(spark, sf_dir).withColumn("step", rp.step_of(F.col("time_utc"), as_of, step_hours))
    st = ts.with_station_hazard(with_station_meta(rp.latest_by_step(series))).join(override, "step")
    st = stage_checkpoint(st.select("step", "lat", "lon", "latest_time_utc", F.greatest(clip("sensor_hazard_score", 0.0, 100.0), F.col(
        "nws_global_alert_score")).alias("flood_hazard_final")), "replay_stations")
    flood = rp.flood_by_step(areas, st)
    quakes = bind.earthquakes(spark, sf_dir).withColumn("step", rp.step_of(F.col("time_utc"), as_of, step_hours))
    quake = rp.quake_by_step(areas, quakes, as_of, lo, step_hours)
    seen = st.groupBy("step").agg(F.max("latest_time_utc").alias("noaa_latest_obs_utc"))

    d = areas.select(*STILL).withColumn("step", rp.steps_from(lo)).join(flood, ["area_id", "step"], "left").join(quake, ["area_id", "step"], "left")
    d = d.join(override, "step").join(seen, "step", "left")
    d = d.withColumn("flood_hazard_muni", F.greatest("flood_hazard_weighted", "flood_hazard_local_max", "nws_global_alert_score"))
    d = sc.robust_score(stage_checkpoint(d, "replay_hazard"), "earthquake_raw", "earthquake_hazard_score", partition_by=["step"])
    d = d.withColumn("earthquake_hazard_score", F.coalesce("earthquake_hazard_score", F.lit(0.0)))
    d = d.withColumn("hazard_combined", F.greatest("flood_hazard_muni", "earthquake_hazard_score"))
    d = d.withColumn("step_utc", rp.step_time("step", as_of, step_hours))
    d = sc.with_confidence(sc.with_operational_indices(d, phase), F.col("step_utc"))
    d = sc.with_bands(sc.with_confidence_adjustment(d, ["step"]))
    return d.select("area_id", "municipio", F.col("step_utc").cast("timestamp_ntz").alias("step_utc"), "nws_global_alert_score", "flood_hazard_muni",
                    "earthquake_raw", "earthquake_hazard_score", "hazard_combined", "risk_index_raw", "response_readiness_index",
                    "recovery_capacity_index", "priority_index", "confidence_score", "priority_index_conf_adj", "priority_band")
