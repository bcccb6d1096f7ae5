"""Per-station series operators (W-01, W-02, W-04, D-02, D-27, SP-17..SP-19).

Scale notes
-----------
* "Latest k rows per station" is a ``row_number() <= k`` filter.  Spark
  plans it with a *partial* WindowGroupLimit before the exchange, so each map
  task ships at most k rows per station: a station holding a third of all
  rows costs no more shuffle than any other.
* Whole-series statistics (count, peak, mean, latest row) are one hash
  aggregate with map-side partial aggregation; the latest row is the max of a
  (time, id, ...) struct, so no window and no second join is needed.
* Operators that truly need every row in order (gaps, per-row rates) sort the
  rows into range partitions of (station, time) and lag inside a partition; a
  partition's first row takes the last row of the partition before it
  (``with_prev``), so no task ever holds an unbounded station.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.config import EXCEED_BOUNDS, MIN_DELTA_HOURS, RISE_BOUNDS
from tidewatch.functions.numeric import clip, nan_mean, normalize_linear
from tidewatch.functions.timefn import hours_between, hours_between_floor, minutes_between


def latest_k(series: DataFrame, k: int, key: str | list[str] = "station_id", time_col: str = "time_utc",
             tie_col: str = "obs_id") -> DataFrame:
    """W-01: the k most recent rows per key, with ``rn`` (1 = latest).

    Ties on time are broken by ``tie_col`` descending (Q10).
    """
    w = Window.partitionBy(key).orderBy(F.col(time_col).desc(), F.col(tie_col).desc())
    return series.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)


def latest_and_previous(series: DataFrame, key: str = "station_id", time_col: str = "time_utc",
                        tie_col: str = "obs_id", value_col: str = "water_level") -> DataFrame:
    """W-01 + W-02: one row per key with the latest and previous reading.

    A key with a single reading gets itself as previous (Q23), so its rate
    is 0, not missing.
    """
    top = latest_k(series, 2, key, time_col, tie_col)
    rec = F.struct(F.col(time_col).alias("t"), F.col(value_col).alias("v"))
    agg = top.groupBy(key).agg(
        F.max(F.when(F.col("rn") == 1, rec)).alias("l"),
        F.max(F.when(F.col("rn") == 2, rec)).alias("p"),
    )
    return agg.select(
        key,
        F.col("l.t").alias("latest_time_utc"),
        F.col("l.v").alias("latest_water_level"),
        F.coalesce(F.col("p.t"), F.col("l.t")).alias("prev_time_utc"),
        F.when(F.col("p").isNull(), F.col("l.v")).otherwise(F.col("p.v")).alias("prev_water_level"),
    )


def rise_rate(latest_v, prev_v, latest_t, prev_t) -> Column:
    """D-02: (latest - previous) / max(hours, 1e-6); missing if either value is."""
    dh = hours_between_floor(latest_t, prev_t, MIN_DELTA_HOURS)
    lv, pv = F.col(latest_v), F.col(prev_v)
    return F.when(lv.isNotNull() & pv.isNotNull(), (lv - pv) / dh)


def exceed_ratio(value, minor, major) -> Column:
    """D-03: (v - minor) / (major - minor) only when all present and major > minor."""
    v, lo, hi = F.col(value), F.col(minor), F.col(major)
    ok = v.isNotNull() & lo.isNotNull() & hi.isNotNull() & (hi > lo)
    return F.when(ok, (v - lo) / (hi - lo))


def minor_threshold(nos_minor, action) -> Column:
    """Q14: ``nos_minor or action`` -- a zero nos_minor falls through to action."""
    return F.coalesce(F.when(F.col(nos_minor) != 0, F.col(nos_minor)), F.col(action))


def with_station_hazard(df: DataFrame) -> DataFrame:
    """D-03 + D-01 + D-04 on a latest/previous table with thresholds."""
    return (df
            .withColumn("rise_rate_per_hour", rise_rate("latest_water_level", "prev_water_level",
                                                        "latest_time_utc", "prev_time_utc"))
            .withColumn("exceed_ratio", exceed_ratio("latest_water_level", "minor", "major"))
            .withColumn("exceed_score", normalize_linear("exceed_ratio", *EXCEED_BOUNDS))
            .withColumn("rise_score", normalize_linear("rise_rate_per_hour", *RISE_BOUNDS))
            .withColumn("sensor_hazard_score",
                        F.coalesce(nan_mean("exceed_score", "rise_score"), F.lit(0.0))))


def with_alert_override(df: DataFrame, global_alert: Column) -> DataFrame:
    """D-06: flood_hazard_final = max(clip(sensor, 0, 100), global alert score)."""
    return (df.withColumn("nws_global_alert_score", global_alert.cast("double"))
              .withColumn("flood_hazard_final",
                          F.greatest(clip("sensor_hazard_score", 0.0, 100.0), F.col("nws_global_alert_score"))))


def station_summary(series: DataFrame, key: str = "station_id") -> DataFrame:
    """D-27 core: latest row + count (non-null), peak and mean of the value.

    One aggregate; the latest row is the max of (time, id, value, quality).
    """
    latest = F.max(F.struct("time_utc", "obs_id", "water_level", "quality"))
    agg = series.groupBy(key).agg(
        latest.alias("l"),
        F.count("water_level").alias("obs_count"),
        F.max("water_level").alias("peak_value"),
        F.avg("water_level").alias("mean_value"),
    )
    return agg.select(
        key,
        F.col("l.time_utc").alias("latest_time_utc"),
        F.col("l.water_level").alias("latest_value"),
        F.col("l.quality").alias("latest_quality"),
        "obs_count", "peak_value", "mean_value",
    )


def lookback(series: DataFrame, as_of: Column, hours: float, time_col: str = "time_utc") -> DataFrame:
    """F-09: rows with as_of - hours <= time <= as_of."""
    t = F.col(time_col)
    return series.filter((t >= as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0)))
                         & (t <= as_of))


def with_prev(series: DataFrame, key: str = "station_id", time_col: str = "time_utc",
              tie_col: str = "obs_id", cols=("water_level",)) -> DataFrame:
    """Previous row per key (time order) for every row: ``prev_<col>`` columns.

    Skew-proof: the rows are range-partitioned and sorted on (key, time, tie),
    so a station holding a third of all rows is spread over many balanced
    partitions, and numbered in sort order; the numbered table is written
    once to the checkpoint folder (numbers fixed, lineage cut).  Inside a sort
    partition the previous row is a lag over that partition, whose size is
    set by the range partitioner, not by the key; the first row of a
    partition takes the last row of the preceding non-empty partition from a
    per-partition aggregate (one row per partition, broadcast).  A previous
    row of another key is no previous row (nulls).
    """
    from tidewatch.session import stage_checkpoint
    carry = (time_col, tie_col) + tuple(c for c in cols if c not in (time_col, tie_col))
    s = series.orderBy(key, time_col, tie_col).withColumn("_gid", F.monotonically_increasing_id())
    s = stage_checkpoint(s, "sorted_series").withColumn("_pid", F.shiftright(F.col("_gid"), 33))
    w = Window.partitionBy("_pid").orderBy("_gid")
    s = s.withColumn("_lag", F.lag(F.struct(key, *carry)).over(w))
    last = s.groupBy("_pid").agg(F.max(F.struct("_gid", key, *carry)).alias("_last"))
    # one row per sort partition: bounded by the partition count by construction
    last_row = F.struct(*[F.col("_last")[c].alias(c) for c in (key,) + carry])
    seeds = last.select("_pid", F.lag(last_row).over(Window.orderBy("_pid")).alias("_seed"))
    s = s.join(F.broadcast(seeds), "_pid", "left")
    prev = F.when(F.col("_lag").isNull(), F.col("_seed")).otherwise(F.col("_lag"))
    s = s.withColumn("_prev", F.when(prev[key] == F.col(key), prev))
    s = s.withColumns({f"prev_{c}": F.col("_prev")[c] for c in carry})
    return s.drop("_gid", "_pid", "_lag", "_seed", "_prev")


def out_of_order(series: DataFrame, key: str = "station_id", time_col: str = "time_utc", tie_col: str = "obs_id",
                 arrival_col: str | None = None) -> DataFrame:
    """SP-17: readings that arrive (by ``arrival_col``, then ``tie_col``) after one with a later time.

    Returns key, time, tie and ``latest_before``, the largest time that arrived before.
    A running maximum over a key's rows in arrival order, without a window over the
    key: rows are range-sorted by (key, arrival) and written once; inside a sort
    partition the maximum runs per key, and the first key of a partition is seeded
    with the maximum of the partitions before that end in the same key (one row per
    partition).  Rows without a time never are out of order.
    """
    from tidewatch.session import discard_stage, stage_checkpoint
    arrival = F.col(arrival_col or tie_col)
    s = series.orderBy(key, arrival, tie_col).select(key, time_col, tie_col).withColumn("_gid", F.monotonically_increasing_id())
    stored = stage_checkpoint(s, "arrival_order")
    s = stored.withColumn("_pid", F.shiftright(F.col("_gid"), 33))
    # one row per sort partition: its first and last key, and the last key's largest time in it
    ends = s.groupBy("_pid").agg(F.min(F.struct("_gid", key))[key].alias("_first"), F.max(F.struct("_gid", key))[key].alias("_last"))
    tops = s.groupBy("_pid", F.col(key).alias("_last")).agg(F.max(time_col).alias("_top"))
    ends = ends.join(tops, (ends["_pid"] == tops["_pid"]) & ends["_last"].eqNullSafe(tops["_last"])).select(ends["_pid"], "_first", ends["_last"], "_top")
    upto = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    line = Window.orderBy("_pid")
    ends = ends.withColumn("_top", F.max("_top").over(upto))
    seeds = ends.select("_pid", "_first", F.when(F.lag("_last").over(line).eqNullSafe(F.col("_first")), F.lag("_top").over(line)).alias("_seed"))
    before = Window.partitionBy("_pid", key).orderBy("_gid").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_run", F.max(time_col).over(before))
    # one row per sort partition: bounded by the partition count by construction
    s = s.join(F.broadcast(seeds.withColumnRenamed("_pid", "_sp")), F.col("_pid") == F.col("_sp"))
    seed = F.when(F.col(key).eqNullSafe(F.col("_first")), F.col("_seed"))
    s = s.withColumn("latest_before", F.greatest("_run", seed))
    return discard_stage(stage_checkpoint(s.filter(F.col("latest_before") > F.col(time_col)).select(key, time_col, tie_col, "latest_before"), "out_of_order"), stored)


def gaps(series: DataFrame, cadence_minutes: float, factor: float = 2.0, key: str = "station_id",
         time_col: str = "time_utc", tie_col: str = "obs_id", arrival_col: str | None = None) -> DataFrame:
    """SP-17: gaps longer than factor x cadence, duplicate timestamps, and readings out of order.

    Returns one row per flagged observation and kind: key, time, previous time,
    gap_seconds, kind ('gap' | 'duplicate' | 'out_of_order').  The first two compare
    with the previous reading in time; the last compares the order of arrival
    (``arrival_col``, else ``tie_col``) with time, its previous time is the latest that had arrived before.
    """
    s = with_prev(series.select(key, time_col, tie_col), key, time_col, tie_col, cols=())
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    s = s.withColumn("_gap_us", micros(time_col) - micros(f"prev_{time_col}"))
    kind = (F.when(F.col("_gap_us") == 0, "duplicate")
            .when(F.col("_gap_us") > F.lit(int(cadence_minutes * factor * 60_000_000)), "gap"))
    in_time = (s.withColumn("kind", kind).filter(F.col("kind").isNotNull())
                .select(key, time_col, tie_col, F.col(f"prev_{time_col}").alias("prev_time_utc"), (F.col("_gap_us") / F.lit(1e6)).alias("gap_seconds"), "kind"))
    late = out_of_order(series, key, time_col, tie_col, arrival_col).select(
        key, time_col, tie_col, F.col("latest_before").alias("prev_time_utc"),
        ((micros(time_col) - micros("latest_before")) / F.lit(1e6)).alias("gap_seconds"), F.lit("out_of_order").alias("kind"))
    return in_time.unionByName(late)


def per_row_rate(series: DataFrame, key: str = "station_id", time_col: str = "time_utc",
                 tie_col: str = "obs_id", value_col: str = "water_level") -> DataFrame:
    """W-04: rate of change against the previous row, for every row of the series."""
    s = with_prev(series.select(key, time_col, tie_col, value_col), key, time_col, tie_col, cols=(value_col,))
    return s.withColumn("rate_per_hour", rise_rate(value_col, f"prev_{value_col}", time_col, f"prev_{time_col}"))


def outliers(series: DataFrame, z: float = 3.0, key: str = "station_id", value_col: str = "water_level",
             lo: float | None = None, hi: float | None = None, tie_col: str = "obs_id") -> DataFrame:
    """SP-18: z-score outliers per station and plausibility-range violations.

    Station mean and stddev come from a partial aggregate and are joined back
    with salted keys, so a station with a third of all rows is many tasks.
    """
    from tidewatch.operators.ranking import join_stats
    stats = series.groupBy(F.col(key).alias("_key")).agg(F.avg(value_col).alias("mu"), F.stddev_samp(value_col).alias("sd"))
    s = join_stats(series, stats, [key], ["_key"], tie_col)
    zc = F.try_divide(F.col(value_col) - F.col("mu"), F.col("sd"))
    s = s.withColumn("z_score", zc)
    bad_range = F.lit(False)
    if lo is not None:
        bad_range = bad_range | (F.col(value_col) < lo)
    if hi is not None:
        bad_range = bad_range | (F.col(value_col) > hi)
    flag = F.coalesce(F.abs(F.col("z_score")) > z, F.lit(False)) | F.coalesce(bad_range, F.lit(False))
    return s.withColumn("is_outlier", flag).drop("mu", "sd")


def trend(series: DataFrame, key: str = "station_id", time_col: str = "time_utc",
          value_col: str = "water_level") -> DataFrame:
    """SP-19: least-squares slope of value on time (units per hour) per station."""
    hours = F.unix_micros(F.col(time_col).cast("timestamp")) / F.lit(3.6e9)
    return series.groupBy(key).agg(
        F.regr_slope(F.col(value_col), hours).alias("slope_per_hour"),
        F.regr_count(F.col(value_col), hours).alias("n_points"),
    )
