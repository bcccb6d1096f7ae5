"""Bindings: the driver's test tables mapped onto the domain entities.

The landed feeds (tide gauges, alerts, earthquakes, ACS tables, towns) are
not part of the test data, so each entity is derived from a test table with
twin in ``tidewatch.plans.oracle`` written in DuckDB SQL; change both or
neither.

All derivations are projections or partial-aggregating group-bys over whole
tables; nothing is sampled or capped.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import normalize_text, zero_pad_code

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reader for one landed table, as its files are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """Number of rows of a table (a scalar subquery)."""
    return read_table(spark, sf_dir, name).select(F.count(F.lit(1))).scalar()


def _lit(x: float) -> Column:
    return F.lit(float(x))


# ---------------------------------------------------------------------------
# Stations (events)
# ---------------------------------------------------------------------------

def station_meta_columns(station_id: Column) -> dict[str, Column]:
    """Station metadata as pure functions of the station id (no join needed).

    Edge rows: thresholds missing (id % 7 = 0), nos_minor = 0 with action set
    (id % 13 = 0), major missing (id % 11 = 0), major <= minor (id % 19 = 0),
    non-tidal station (id % 10 = 9).
    """
    sid = station_id
    base_minor = _lit(1.0) + (sid % 5) * _lit(0.5)
    nos_minor = (F.when(sid % 7 == 0, F.lit(None).cast("double"))
                 .when(sid % 13 == 0, _lit(0.0)).otherwise(base_minor))
    action = F.when(sid % 7 == 0, F.lit(None).cast("double")).otherwise(_lit(0.8) + (sid % 4) * _lit(0.5))
    nos_major = (F.when(sid % 11 == 0, F.lit(None).cast("double"))
                 .when(sid % 19 == 0, base_minor).otherwise(_lit(4.0) + (sid % 5) * _lit(0.5)))
    return {
        "station_name": F.concat(F.lit("Station "), sid.cast("string")),
        "shefcode": F.concat(F.lit("PR"), zero_pad_code(sid, 4)),
        "lat": _lit(17.9) + ((sid * 7) % 60) / _lit(100.0),
        "lon": _lit(-67.3) + ((sid * 13) % 210) / _lit(100.0),
        "nos_minor": nos_minor,
        "action": action,
        "nos_moderate": _lit(2.0) + (sid % 5) * _lit(0.5),
        "nos_major": nos_major,
        "tidal": (sid % 10) != 9,
    }


def station_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station_id, obs_id, time_utc, water_level, quality, flags (+ metadata)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("user_id").alias("station_id"),
        F.col("event_id").alias("obs_id"),
        F.col("ts").alias("time_utc"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") / _lit(10.0)).alias("water_level"),
        F.col("event_type").alias("quality"),
        F.concat_ws(",", (k % 2).cast("string"), (k % 3).cast("string"), F.lit("0"), F.lit("0")).alias("flags"),
    )


def series_as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Run time of the batch: the latest observation time (never the clock)."""
    return read_table(spark, sf_dir, "events").select(F.max("ts")).scalar()


# ---------------------------------------------------------------------------
# Alerts (orders, lineitem)
# ---------------------------------------------------------------------------

ALERT_ACTIVE_DAYS = 3


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw alert rows: id, event, severity, sent/onset/ends, area_desc, sender."""
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    m = key % 100
    event = (F.when(m == 0, "Flash Flood Warning").when(m < 5, "Flood Warning")
             .when(m < 15, "Flood Watch").when(m < 25, "Flood Advisory")
             .when(F.col("o_orderpriority") == "1-URGENT", "Wind Advisory")
             .when(F.col("o_orderpriority") == "2-HIGH", "Heat Advisory")
             .otherwise("Special Weather Statement"))
    severity = (F.when(key % 211 == 0, "Extreme")
                .when(F.col("o_orderpriority") == "1-URGENT", "Severe")
                .when(F.col("o_orderpriority") == "2-HIGH", "Moderate")
                .when(F.col("o_orderpriority") == "3-MEDIUM", "Minor")
                .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Unknown"))
    area_desc = F.concat(F.lit("Supplier#"), zero_pad_code(F.col("o_custkey") % table_rows(spark, sf_dir, "supplier"), 9))
    return o.select(
        F.concat(F.lit("urn:alert:"), key.cast("string")).alias("id"),
        key.alias("alert_key"),
        event.alias("event"),
        severity.alias("severity"),
        F.when(F.col("o_orderstatus") == "F", "Immediate").otherwise("Expected").alias("urgency"),
        F.when(F.col("o_orderstatus") == "P", "Possible").otherwise("Likely").alias("certainty"),
        F.concat(event, F.lit(" issued for "), area_desc).alias("headline"),
        F.col("o_orderdate").alias("sent"),
        F.col("o_orderdate").alias("onset"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {ALERT_ACTIVE_DAYS} DAYS")).alias("ends"),
        F.lit("Actual").alias("status"),
        area_desc.alias("area_desc"),
        F.when(key % 3 == 0, "NWS San Juan PR").otherwise("NWS Miami FL").alias("sender_name"),
    )


def alert_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(alert_key, zone_id) pairs: each line item names one forecast zone."""
    return zone_rows(read_table(spark, sf_dir, "lineitem"))


def zone_rows(li: DataFrame) -> DataFrame:
    """The zones that line items name."""
    zone = F.concat(F.lit("PRZ"), F.lpad(((F.col("l_suppkey") % 13) + 1).cast("string"), 3, "0"))
    return li.select(F.col("l_orderkey").alias("alert_key"), zone.alias("zone_id"))


def active_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts active at the run time (onset <= as_of < ends), as_of = latest onset."""
    a = alerts(spark, sf_dir)
    as_of = read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    return a.filter((F.col("onset") <= as_of) & (F.col("ends") > as_of))


# ---------------------------------------------------------------------------
# Earthquakes (events)
# ---------------------------------------------------------------------------

def earthquakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an earthquake; its type is the review status."""
    return quake_rows(read_table(spark, sf_dir, "events"))


def quake_rows(ev: DataFrame) -> DataFrame:
    """Events as earthquakes."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        eid.alias("event_id"),
        F.col("ts").alias("time_utc"),
        F.when(eid % 23 == 0, F.lit(None).cast("double"))
         .otherwise(_lit(1.0) + F.col("value") % _lit(6.0)).alias("magnitude"),
        F.when(eid % 29 == 0, F.lit(None).cast("double")).otherwise(k * _lit(2.0)).alias("depth_km"),
        (_lit(17.0) + (eid % 300) / _lit(100.0)).alias("latitude"),
        (_lit(-68.5) + ((eid * 7) % 500) / _lit(100.0)).alias("longitude"),
        F.concat(F.lit("event "), eid.cast("string")).alias("place"),
        F.col("event_type").alias("status"),
    )


# ---------------------------------------------------------------------------
# Census carriers: areas (nation), ZIPs (customer groups), towns (supplier)
# ---------------------------------------------------------------------------

SENTINEL = -666666666.0


def zip_code_of(nationkey: Column, slot: Column) -> Column:
    return F.lpad((F.lit(600) + nationkey * 4 + slot).cast("string"), 5, "0")


def _acs_aggs() -> list[Column]:
    c = F.col
    return [
        F.count(F.lit(1)).cast("double").alias("population"),
        F.avg("c_acctbal").alias("median_income_raw"),
        F.count(F.lit(1)).cast("double").alias("poverty_universe"),
        F.count_if(c("c_acctbal") < 1000).cast("double").alias("poverty_count"),
        F.count(F.lit(1)).cast("double").alias("housing_units"),
        F.count_if(c("c_mktsegment") != "HOUSEHOLD").cast("double").alias("occupied_units"),
        F.count_if(c("c_mktsegment") == "HOUSEHOLD").cast("double").alias("vacant_units"),
        F.count_if(c("c_mktsegment") == "AUTOMOBILE").cast("double").alias("no_vehicle_owner"),
        F.count_if(c("c_mktsegment") == "MACHINERY").cast("double").alias("no_vehicle_renter"),
    ]


def acs_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ACS-like table per area (one row per nation), sentinel injected."""
    cust = read_table(spark, sf_dir, "customer")
    nat = read_table(spark, sf_dir, "nation")
    agg = cust.groupBy("c_nationkey").agg(*_acs_aggs())
    out = nat.join(agg, nat.n_nationkey == agg.c_nationkey, "left")
    return out.select(
        F.col("n_nationkey").alias("area_id"),
        F.col("n_name").alias("municipio"),
        "population",
        F.when(F.col("n_nationkey") % 9 == 4, F.lit(SENTINEL))
         .otherwise(F.col("median_income_raw")).alias("median_income"),
        "poverty_universe", "poverty_count", "housing_units", "occupied_units",
        "vacant_units", "no_vehicle_owner", "no_vehicle_renter",
    )


def acs_zcta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ACS-like table per ZIP code (customers grouped by nation and slot)."""
    cust = read_table(spark, sf_dir, "customer")
    z = cust.withColumn("zip_code", zip_code_of(F.col("c_nationkey"), F.col("c_custkey") % 4))
    return z.groupBy("zip_code").agg(*_acs_aggs()).withColumnRenamed("median_income_raw", "median_income")


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Town lookup: designated_area, municipio, latitude, longitude, 'Zip Codes' text.

    Edge rows: no ZIP text (suppkey % 10 = 3), a ZIP absent from the ZCTA
    table and a repeated ZIP (suppkey % 10 = 7), null latitude (suppkey % 17 = 16).
    """
    s = read_table(spark, sf_dir, "supplier")
    nat = read_table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    z1 = zip_code_of(F.col("s_nationkey"), key % 4)
    z2 = zip_code_of(F.col("s_nationkey"), (key + 1) % 4)
    zip_text = (F.when(key % 10 == 3, F.lit(None).cast("string"))
                .when(key % 10 == 7, F.concat(z1, F.lit(", "), z1, F.lit("; 00999")))
                .otherwise(F.concat(z1, F.lit(", "), z2)))
    j = s.join(nat, s.s_nationkey == nat.n_nationkey, "left")
    return j.select(
        F.col("s_name").alias("designated_area"),
        F.col("n_name").alias("municipio"),
        F.when(key % 17 == 16, F.lit(None).cast("double"))
         .otherwise(_lit(17.95) + ((key * 3) % 50) / _lit(100.0)).alias("latitude"),
        (_lit(-67.2) + ((key * 11) % 190) / _lit(100.0)).alias("longitude"),
        zip_text.alias("zip_codes_text"),
    )


def area_key(col: Column) -> Column:
    return normalize_text(col)


# ---------------------------------------------------------------------------
# Observed outcomes per area (labels) -- the backtest "event library"
# ---------------------------------------------------------------------------

def area_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed impact per area: labels folded onto areas by doc_id modulo the
    area count (impact_count = toxic labels, impact_observed = any)."""
    lab = read_table(spark, sf_dir, "labels")
    return lab.groupBy((F.col("doc_id") % table_rows(spark, sf_dir, "nation")).cast("long").alias("area_id")).agg(
        F.sum("toxic").cast("long").alias("impact_count"),
        F.max("toxic").cast("long").alias("impact_observed"),
    )


# ---------------------------------------------------------------------------
# Spec indicator carriers (long format: area_id, indicator, value)
# ---------------------------------------------------------------------------

def _stack(wide: DataFrame, key: str, names: list[str]) -> DataFrame:
    return wide.unpivot([key], names, "indicator", "value")


def area_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infrastructure (ICS), readiness and recovery indicators per area.

    ICS sectors come from line items by supplier nation; readiness and
    recovery from orders by customer nation.  Both are partial-aggregating
    group-bys over the whole fact tables.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_discount", "l_tax", "l_quantity", "l_returnflag", "l_linestatus", "l_extendedprice")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = F.col
    ics = li.join(sup, li.l_suppkey == sup.s_suppkey).groupBy(c("s_nationkey").cast("long").alias("area_id")).agg(
        F.avg("l_discount").alias("hospitals"),
        F.avg("l_tax").alias("power"),
        F.avg("l_quantity").alias("water"),
        (F.avg((c("l_returnflag") == "R").cast("double")) * 100.0).alias("roads_bridges"),
        (F.avg((c("l_linestatus") == "O").cast("double")) * 100.0).alias("telecom"),
        F.avg("l_extendedprice").alias("ports"),
        F.count(F.lit(1)).cast("double").alias("airports"),
        F.sum("l_quantity").alias("emergency_facilities"),
    )
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    rr = o.join(cu, o.o_custkey == cu.c_custkey).groupBy(c("c_nationkey").cast("long").alias("area_id")).agg(
        (F.avg((c("o_orderstatus") == "F").cast("double")) * 100.0).alias("route_reliability"),
        (F.avg("o_totalprice") / 1000.0).alias("resource_proximity"),
        (F.avg(c("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")) * 100.0).alias("comms_reach"),
        F.max((c("o_orderpriority") == "1-URGENT").cast("double")).alias("eoc_staffing_flag"),
        (F.avg("o_totalprice") / 10000.0).alias("utility_restoration_velocity"),
        (F.avg("c_acctbal") / 100.0).alias("healthcare_access_restoration"),
        (F.avg((c("o_orderstatus") != "P").cast("double")) * 100.0).alias("school_reopening_pct"),
        (F.avg((c("c_mktsegment") == "HOUSEHOLD").cast("double")) * 100.0).alias("housing_habitability_proxy"),
    )
    ics_names = [n for n in ics.columns if n != "area_id"]
    rr_names = [n for n in rr.columns if n != "area_id"]
    return _stack(ics, "area_id", ics_names).unionByName(_stack(rr, "area_id", rr_names))


# indicator -> (index, direction, policy, fixed lo, fixed hi); weights come from config
INDICATOR_SPEC = {
    "hospitals": ("ics", "higher_worse", "percentiles", None, None),
    "power": ("ics", "higher_worse", "percentiles", None, None),
    "water": ("ics", "higher_worse", "percentiles", None, None),
    "roads_bridges": ("ics", "higher_worse", "fixed", 0.0, 100.0),
    "telecom": ("ics", "higher_worse", "fixed", 0.0, 100.0),
    "ports": ("ics", "higher_worse", "percentiles", None, None),
    "airports": ("ics", "higher_worse", "percentiles", None, None),
    "emergency_facilities": ("ics", "higher_worse", "percentiles", None, None),
    "route_reliability": ("readiness", "higher_better", "fixed", 0.0, 100.0),
    "resource_proximity": ("readiness", "lower_better", "percentiles", None, None),
    "comms_reach": ("readiness", "higher_better", "fixed", 0.0, 100.0),
    "eoc_staffing_flag": ("readiness", "higher_better", "fixed", 0.0, 1.0),
    "utility_restoration_velocity": ("recovery", "higher_better", "percentiles", None, None),
    "healthcare_access_restoration": ("recovery", "lower_better", "percentiles", None, None),
    "school_reopening_pct": ("recovery", "higher_better", "fixed", 0.0, 100.0),
    "housing_habitability_proxy": ("recovery", "higher_worse", "percentiles", None, None),
}


def indicator_meta_rows() -> list[tuple]:
    from tidewatch import config as C
    weights = {"ics": C.SPEC_ICS_WEIGHTS, "readiness": C.SPEC_READINESS_WEIGHTS, "recovery": C.SPEC_RECOVERY_WEIGHTS}
    rows = []
    for ind, (idx, direction, policy, lo, hi) in INDICATOR_SPEC.items():
        rows.append((ind, idx, float(weights[idx][ind]), direction, policy, lo, hi))
    return rows
