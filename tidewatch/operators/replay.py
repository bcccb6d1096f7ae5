"""Steps of a replay: as-of states, interval timelines and running maxima (SP-04, SP-28).

A replay recomputes results at evenly spaced times.  Steps are whole numbers
counted from the run time: step 0 is the run time, step -1 one step length
earlier.  Everything is first reduced to rows per (key, step), where a step stands
for the time since the step before; states at a step then follow from a running
aggregate per key over its steps.  So the raw rows are read once, whatever the
number of steps, and a window never holds more rows per key than there are steps,
however hot the key.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.geo import distance_attenuation
from tidewatch.functions.timefn import as_utc, hours_between
from tidewatch.operators.spatial import kernel_pairs
from tidewatch.operators.timeseries import latest_k


def step_of(time, as_of: Column, step_hours: float) -> Column:
    """First step at or after a time."""
    behind = F.unix_micros(as_utc(as_of)) - F.unix_micros(as_utc(time))
    length = F.lit(int(step_hours * 3_600_000_000))
    return (-(behind - F.pmod(behind, length)) / length).cast("long")


def step_time(step, as_of: Column, step_hours: float) -> Column:
    """The time a step stands for."""
    step = step if isinstance(step, Column) else F.col(step)
    return F.timestamp_micros(F.unix_micros(as_utc(as_of)) + step * F.lit(int(step_hours * 3_600_000_000)))


def steps_from(lo: Column, hi: Column | None = None) -> Column:
    """One row per step from ``lo`` to ``hi`` (the run time), no row if there is none."""
    hi = F.lit(0).cast("long") if hi is None else hi.cast("long")
    lo = lo.cast("long")
    return F.explode(F.when(lo <= hi, F.sequence(lo, hi, F.lit(1).cast("long"))))


def latest_by_step(series: DataFrame, key: str = "station_id", time_col: str = "time_utc", value_col: str = "water_level") -> DataFrame:
    """Latest and previous reading of every key at every step from its first reading on.

    ``series`` has a ``step`` column.  Per (key, step) only the two latest rows matter;
    a step with one reading takes the latest of the steps before as its previous
    one, a step without any keeps the state before.  The columns are those of
    ``latest_and_previous``, at each step with the same values.
    """
    top = latest_k(series.select(key, "step", time_col, "obs_id", value_col), 2, [key, "step"], time_col)
    reading = F.struct(F.col(time_col).alias("t"), F.col(value_col).alias("v"))
    per = top.groupBy(key, "step").agg(F.max(F.when(F.col("rn") == 1, reading)).alias("l"), F.max(F.when(F.col("rn") == 2, reading)).alias("p"))
    line = Window.partitionBy(key).orderBy("step")
    per = per.withColumn("p", F.coalesce("p", F.lag("l").over(line)))
    # between two steps with readings the state stands still
    upto = F.coalesce(F.lead("step").over(line) - F.lit(1), F.greatest(F.col("step"), F.lit(0)))
    held = per.withColumn("_upto", upto).filter("_upto >= step").select(
        key, F.explode(F.sequence(F.col("step"), F.col("_upto"))).alias("step"), "l", "p")
    return held.select(key, "step", F.col("l.t").alias("latest_time_utc"), F.col("l.v").alias("latest_water_level"),
                       F.coalesce(F.col("p.t"), F.col("l.t")).alias("prev_time_utc"),
                       F.when(F.col("p").isNull(), F.col("l.v")).otherwise(F.col("p.v")).alias("prev_water_level"))


def level_timeline(intervals: DataFrame, keys: list[str], lo: Column, hi: Column | None = None, level: str = "level") -> DataFrame:
    """Largest level and number of intervals that cover a step, per key and step.

    ``intervals``: the keys, ``begin`` and ``end`` (steps) and a level; one covers the
    steps from its begin up to, not including, its end; without an end it never
    ends, without a begin or with none before its end it covers nothing.  A
    sweep: begins count one, ends take it back, and per (key, level) the running
    sum tells how many are open.  The events are summed per (key, level, step)
    before any shuffle, so a hot key ships one row per level and step of a task.
    Steps that nothing covers have no row.
    """
    hi = F.lit(0).cast("long") if hi is None else hi.cast("long")
    first = F.greatest(F.col("begin"), lo.cast("long"))
    open_ = intervals.filter(F.col("begin").isNotNull() & F.col(level).isNotNull() & (F.col("begin") <= hi)
                             & (F.col("end").isNull() | (F.col("end") > first)))
    ends = F.when(F.col("end") <= hi, F.struct(F.col("end").alias("at"), F.lit(-1).alias("n")))
    events = F.array_compact(F.array(F.struct(first.alias("at"), F.lit(1).alias("n")), ends))
    e = open_.select(*keys, F.col(level).alias("_level"), F.explode(events).alias("e"))
    e = e.groupBy(*keys, "_level", F.col("e.at").alias("at")).agg(F.sum("e.n").alias("n"))
    line = Window.partitionBy(*keys, "_level").orderBy("at")
    e = e.withColumns({"open": F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0)),
                       "upto": F.coalesce(F.lead("at").over(line) - F.lit(1), hi)})
    spans = e.filter("open > 0").select(*keys, "_level", "open", F.explode(F.sequence("at", "upto")).alias("step"))
    return spans.groupBy(*keys, "step").agg(F.max("_level").alias(level), F.sum("open").alias("n_active"))


def _at_places(rows: DataFrame, values: list[Column]) -> DataFrame:
    """One row per place, its values of all steps in an array (as long as there are steps)."""
    per = rows.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon", "step").agg(*values)
    names = [c for c in per.columns if c not in ("lat", "lon")]
    return per.groupBy("lat", "lon").agg(F.collect_list(F.struct(*names)).alias("_steps"))


def flood_by_step(areas: DataFrame, stations: DataFrame, lambda_km: float = C.LAMBDA_KM, override_km: float = C.OVERRIDE_KM,
                  area_key: str = "area_id") -> DataFrame:
    """The station part of D-15 per area and step: distance-weighted mean and local maximum.

    ``stations``: lat, lon, step, flood_hazard_final.  A pair's distance and weight
    are computed once for all steps.
    """
    h = F.col("flood_hazard_final")
    places = _at_places(stations, [F.sum(h).alias("h"), F.max(h).alias("top"), F.count(F.lit(1)).alias("n")])
    pairs = kernel_pairs(areas, places, area_key).select(
        area_key, F.exp(-F.col("_d") / F.lit(float(lambda_km))).alias("w"), (F.col("_d") <= F.lit(float(override_km))).alias("near"),
        F.explode("_steps").alias("s"))
    agg = pairs.groupBy(area_key, F.col("s.step").alias("step")).agg(
        F.sum(F.col("w") * F.col("s.h")).alias("_swh"), F.sum(F.col("w") * F.col("s.n")).alias("_sw"),
        F.max(F.when(F.col("near"), F.col("s.top"))).alias("flood_hazard_local_max"),
        F.sum("s.n").alias("supporting_station_count"),
        F.coalesce(F.sum(F.when(F.col("near"), F.col("s.n"))), F.lit(0)).alias("nearby_station_count"))
    return agg.withColumn("flood_hazard_weighted", F.try_divide("_swh", "_sw")).drop("_swh", "_sw")


def quake_by_step(areas: DataFrame, quakes: DataFrame, as_of: Column, lo: Column, step_hours: float, depth_fn=None,
                  area_key: str = "area_id") -> DataFrame:
    """D-16 raw part per area and step: the largest decayed intensity of all events up to the step.

    Decay is exponential, so log(intensity) + time / scale of an event does not depend
    on the step: its maximum over events is a running maximum over steps, from
    which a step's own time is subtracted.  Magnitudes of zero and below have no
    logarithm; they are carried as a flag and as a running minimum.
    ``quakes``: latitude, longitude, magnitude, depth_km, time_utc, step.
    """
    from tidewatch.functions.geo import depth_factor
    force = F.coalesce(F.col("magnitude"), F.lit(0.0)) * (depth_fn or depth_factor)("depth_km")
    x = F.log(F.abs(F.col("_f"))) + hours_between(F.col("time_utc"), as_of) / F.lit(C.EQ_RECENCY_HOURS)
    q = quakes.filter(F.col("time_utc").isNotNull()).select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "step", "time_utc", force.alias("_f"))
    places = _at_places(q, [F.max(F.when(F.col("_f") > 0, x)).alias("up"), F.max(F.col("_f") == 0).alias("zero"),
                            F.min(F.when(F.col("_f") < 0, x)).alias("down")])
    pairs = kernel_pairs(areas, places, area_key).select(area_key, F.log(distance_attenuation(F.col("_d"))).alias("far"), F.explode("_steps").alias("s"))
    per = pairs.groupBy(area_key, F.col("s.step").alias("step")).agg(
        F.max(F.col("s.up") - F.col("far")).alias("up"), F.max("s.zero").alias("zero"), F.min(F.col("s.down") - F.col("far")).alias("down"))
    grid = per.select(area_key).distinct().select(area_key, steps_from(lo).alias("step"))
    line = Window.partitionBy(area_key).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    g = grid.join(per, [area_key, "step"], "left").withColumns({
        "up": F.max("up").over(line), "zero": F.max("zero").over(line), "down": F.min("down").over(line),
        "_age": F.col("step") * F.lit(float(step_hours) / C.EQ_RECENCY_HOURS)})
    raw = (F.when(F.col("up").isNotNull(), F.exp(F.col("up") - F.col("_age"))).when(F.col("zero"), F.lit(0.0))
           .when(F.col("down").isNotNull(), -F.exp(F.col("down") - F.col("_age"))))
    return g.select(area_key, "step", raw.alias("earthquake_raw"))
