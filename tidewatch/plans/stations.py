"""Station-level plans: catalogue, latest features, summary (P1 / hydrograph stage)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.alerts import alert_score, global_alert_score
from tidewatch.operators import timeseries as ts
from tidewatch.sources import bind


def with_station_meta(df: DataFrame, key: str = "station_id") -> DataFrame:
    meta = bind.station_meta_columns(F.col(key))
    df = df.withColumns(meta)
    return df.withColumns({
        "minor": ts.minor_threshold("nos_minor", "action"),
        "moderate": F.col("nos_moderate"),
        "major": F.col("nos_major"),
    })


def tidal_series(spark: SparkSession, sf_dir: str, require_tidal: bool = True) -> DataFrame:
    """Series of the stations kept by the datum filter (F-06: missing flag -> false)."""
    s = bind.station_series(spark, sf_dir)
    if require_tidal:
        s = s.filter(F.coalesce(bind.station_meta_columns(F.col("station_id"))["tidal"], F.lit(False)))
    return s


def station_latest_features(spark: SparkSession, sf_dir: str, global_alert: Column | None = None) -> DataFrame:
    """flood_station_latest_features: D-02 .. D-06 per station.

    Plan: scan events (3 columns) -> partial top-2 per station -> exchange on
    station -> final top-2 -> aggregate latest/previous (same partitioning)
    -> per-row expressions.  The global alert score is a scalar subquery.
    """
    s = tidal_series(spark, sf_dir)
    lp = ts.latest_and_previous(s)
    lp = with_station_meta(lp)
    lp = ts.with_station_hazard(lp)
    if global_alert is None:
        global_alert = global_alert_score(alert_score(bind.active_alerts(spark, sf_dir)))
    lp = ts.with_alert_override(lp, global_alert)
    return lp.select(
        "station_id", "station_name", "shefcode", "lat", "lon", "latest_time_utc", "latest_water_level",
        "rise_rate_per_hour", "minor", "moderate", "major", "exceed_ratio", "exceed_score", "rise_score",
        "sensor_hazard_score", "nws_global_alert_score", "flood_hazard_final",
    )


def station_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-27: latest row + count/peak/mean per station, sorted by latest value desc, id."""
    s = tidal_series(spark, sf_dir)
    summ = ts.station_summary(s)
    summ = with_station_meta(summ)
    return summ.select(
        "station_id", "station_name", "latest_time_utc", "latest_value", "latest_quality", "lat", "lon",
        "minor", "moderate", "major", "obs_count", "peak_value", "mean_value",
    ).orderBy(F.col("latest_value").desc_nulls_last(), F.col("station_id"))
