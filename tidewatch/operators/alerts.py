"""Alert operators (D-05, A-01, F-11, A-13, J-16, D-28, SP-04, SP-12, SP-15)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.text import contains_ci


def alert_score_expr(event: Column, severity: Column) -> Column:
    """D-05: flood event text first (100 / 70 / 40), else severity map, default 25."""
    out = None
    for needle, score in C.ALERT_EVENT_SCORES:
        cond = contains_ci(event, needle)
        out = F.when(cond, F.lit(score)) if out is None else out.when(cond, F.lit(score))
    sev = F.lower(F.coalesce(severity, F.lit("")))
    for name, score in C.ALERT_SEVERITY_SCORES.items():
        out = out.when(sev == name, F.lit(score))
    return out.otherwise(F.lit(C.ALERT_DEFAULT_SCORE))


def alert_score(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert_score", alert_score_expr(F.col("event"), F.col("severity")))


def global_alert_score(scored_alerts: DataFrame) -> Column:
    """A-01: max alert score over all alerts; 0 when there are none (scalar subquery)."""
    return scored_alerts.select(F.coalesce(F.max("alert_score").cast("double"), F.lit(0.0))).scalar()


def relevance_filter(df: DataFrame, sender_col: str, sender_value: str, text_cols: list[str],
                     pattern: str) -> DataFrame:
    """F-11: sender equals X, or the (case-insensitive) pattern matches any text column."""
    cond = F.coalesce(F.col(sender_col) == sender_value, F.lit(False))
    for c in text_cols:
        cond = cond | F.coalesce(F.col(c).rlike(f"(?i){pattern}"), F.lit(False))
    return df.filter(cond)


def dedupe_last_seen(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """A-13: one row per key, the last seen (max order_col) wins; null keys dropped.

    Expressed as an aggregate of max(struct(order, row)), which combines
    map-side, so a key repeated many times ships one row per task.
    """
    cols = [c for c in df.columns if c not in (key, order_col)]
    agg = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(F.struct(F.col(order_col), *[F.col(c) for c in cols])).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in [order_col] + cols])


def alerts_enriched(alerts: DataFrame, zones: DataFrame) -> DataFrame:
    """P1 alert rows: score + comma-joined sorted distinct UGC list.

    ``zones`` is (alert_key, zone_id); it is reduced to one array per alert
    by a partial aggregate before the join, so the join is one-to-one.
    """
    z = zones.groupBy("alert_key").agg(F.array_sort(F.collect_set("zone_id")).alias("_ugc"))
    j = alert_score(alerts).join(z, "alert_key", "left")
    return j.withColumn("ugc_list", F.array_join(F.coalesce(F.col("_ugc"), F.array().cast("array<string>")), ","))\
            .drop("_ugc")


#: FIXED VALUES: text that makes an alert relevant, and the texts of a zone without alerts.
RELEVANT_PATTERN = r"puerto\s+rico|PRZ\d{3}|AMZ\d{3}|\bPR\b"
RELEVANT_COLUMNS = ["area_desc", "headline", "description"]
RELEVANT_SENDER = "NWS San Juan PR"
NO_ALERT_EVENT = "No Active Alerts"
NOT_AVAILABLE = "N/A"
NO_ALERT_STATUS = "None"
DEFAULT_STATE = "PR"


def alerts_by_zone(alerts: DataFrame, zones: DataFrame, zone_ref: DataFrame, places: DataFrame, checked_at: Column) -> DataFrame:
    """D-28: one row per relevant alert and zone, and one placeholder per zone without any.

    ``alerts``: id, alert_key, sender_name and the alert's texts; ``zones``:
    (alert_key, zone_id); ``zone_ref``: zone_id, zone_name, zone_lat, zone_lon,
    zone_state; ``places``: designated_area, latitude, longitude, state.  An alert without zones
    has its area text as zone (F-11, A-13, J-16, U-03, T-13).  The area of a
    row is the zone's name, else the zone (J-03, J-04); places are found by
    that name, and a row without a latitude takes the zone's centroid and state (J-05).
    Only zones of relevant alerts are de-duplicated.
    """
    texts = ["event", "headline", "description", "instruction", "response", "severity", "urgency", "certainty", "status"]
    a = alerts.select("id", "alert_key", "sender_name", "area_desc", "sent", F.col("ends").alias("expires"), *texts)
    a = dedupe_last_seen(relevance_filter(a, "sender_name", RELEVANT_SENDER, RELEVANT_COLUMNS, RELEVANT_PATTERN), "id", "sent")
    of_alert = a.select("alert_key").join(zones, "alert_key").distinct()
    rows = a.join(of_alert, "alert_key", "left").withColumn("zone_id", F.coalesce("zone_id", "area_desc"))
    rows = rows.select("id", "zone_id", "sent", "expires", *texts)
    empty = zone_ref.join(rows.select("zone_id").distinct(), "zone_id", "left_anti")
    iso = F.date_format(checked_at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fixed = {"event": F.lit(NO_ALERT_EVENT), "headline": F.concat(F.lit(f"{NO_ALERT_EVENT} for "), F.col("zone_name")),
             "status": F.lit(NO_ALERT_STATUS)}
    empty = empty.select(
        F.concat(F.lit("placeholder_"), F.col("zone_id"), F.lit("_"), iso).alias("id"), "zone_id",
        checked_at.cast(rows.schema["sent"].dataType).alias("sent"), F.lit(None).cast(rows.schema["expires"].dataType).alias("expires"),
        *[fixed.get(t, F.lit(NOT_AVAILABLE)).alias(t) for t in texts])
    u = rows.unionByName(empty).join(zone_ref, "zone_id", "left").withColumn("area_desc", F.coalesce("zone_name", "zone_id"))
    p = places.groupBy("designated_area").agg(F.min_by(F.struct("latitude", "longitude", "state"), "municipio").alias("_p"))
    u = u.join(p, u["area_desc"] == p["designated_area"], "left")
    known = F.col("_p.latitude").isNotNull()
    return u.withColumns({"latitude": F.when(known, F.col("_p.latitude")).otherwise(F.col("zone_lat")),
                          "longitude": F.when(known, F.col("_p.longitude")).otherwise(F.coalesce("zone_lon", "_p.longitude")),
                          "state": F.when(known, F.col("_p.state")).when(F.col("zone_lat").isNotNull(), F.coalesce("zone_state", F.lit(DEFAULT_STATE)))}).drop(
        "designated_area", "_p", "zone_lat", "zone_lon", "zone_name", "zone_state")


def zones_or_fallback(zone_ref: DataFrame) -> DataFrame:
    """S-05: the zone reference, or PRZ001 .. PRZ013 with generated names if it is empty."""
    spark = zone_ref.sparkSession
    empty = zone_ref.select(F.count(F.lit(1)) == 0).scalar()
    made = spark.range(1, C.ZONE_FALLBACK_COUNT + 1).filter(empty).select(
        F.format_string(f"{C.ZONE_FALLBACK_PREFIX}%03d", F.col("id")).alias("zone_id"), F.format_string(f"{C.ZONE_FALLBACK_NAME} %03d", F.col("id")).alias("zone_name"))
    return zone_ref.unionByName(made, allowMissingColumns=True)


def area_alert_score(alerts: DataFrame, zones: DataFrame, at: Column) -> DataFrame:
    """SP-04: per zone, max score over alerts active at ``at`` (onset <= at < ends)."""
    a = alert_score(alerts).filter((F.col("onset") <= at) & (F.col("ends") > at))
    return a.join(zones, "alert_key").groupBy("zone_id").agg(F.max("alert_score").alias("zone_alert_score"))


def phase_from_alerts(alerts: DataFrame, zones: DataFrame, zone_list: DataFrame, at: Column,
                      post_hours: float = C.SPEC_POST_ALERT_HOURS) -> DataFrame:
    """SP-12: phase of every zone of ``zone_list`` from the events the spec names:
    a warning active -> DURING; a watch active -> PRE; one of them ended within
    ``post_hours`` before ``at`` -> POST; otherwise PRE (default readiness).

    Only alerts that can matter (named, begun, ended after ``at - post_hours``)
    meet their zones.
    """
    names = [e for events in C.SPEC_PHASE_EVENTS.values() for e in events]
    since = at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(post_hours * 3600.0))
    a = alerts.filter(F.col("event").isin(names) & (F.col("onset") <= at) & (F.col("ends") > since))
    a = a.select("alert_key", "event", (F.col("ends") > at).alias("_active")).join(zones, "alert_key")
    agg = a.groupBy("zone_id").agg(
        F.max(F.col("_active") & F.col("event").isin(C.SPEC_PHASE_EVENTS["DURING"])).alias("_during"),
        F.max(F.col("_active") & F.col("event").isin(C.SPEC_PHASE_EVENTS["PRE"])).alias("_pre"),
        F.max(~F.col("_active")).alias("_post"))
    phase = (F.when(F.col("_during"), "DURING").when(F.col("_pre"), "PRE").when(F.col("_post"), "POST")
             .otherwise("PRE"))
    return zone_list.select("zone_id").join(agg, "zone_id", "left").select("zone_id", phase.alias("phase"))


def forced_band(event: Column, major_exceeded: Column, band: Column) -> Column:
    """SP-15: Flash Flood Warning forces Red; major flood exceeded forces at least Orange."""
    ffw = contains_ci(event, "flash flood warning")
    return (F.when(ffw, F.lit("Red"))
             .when(F.coalesce(major_exceeded, F.lit(False)) & band.isin("Green", "Yellow"), F.lit("Orange"))
             .otherwise(band))
