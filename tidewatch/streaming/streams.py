"""Structured Streaming variants of the batch operators (ST-01 .. ST-06).

* ST-01 file-stream ingest with an explicit schema (``readStream.schema()``)
  over a table that is one file or a folder of part files with any names,
  Parquet or JSON; a trigger takes all files up to ``BATCH_BYTES``.
* ST-02 de-duplication on the declared key, over all rows or within a watermark.
* ST-03 sliding hourly station statistics (60 min windows every 15 min).
* ST-04 latest and previous reading per station across micro-batches: each batch
  merges its rows with the state of the stations it names (top-2 per station,
  WindowGroupLimit) and stores only those (``state.KeyedState``); no Python
  worker.  ``streaming.stateful`` has the same with Spark's state API.
* ST-05 the area indices rescored after every batch from an incremental area
  state: a changed station moves its area sums by the difference it makes.
* ST-06 alert sessions per zone (24 h gap) from a stream of alerts and a stream of
  their zones: both are kept, whichever comes first, and new pairs are merged
  into the sessions of their zones.

Files may arrive in any order.  ``state_dir`` names the folder of a query's state,
output and checkpoint, to continue there when it is started again; without it
each run starts afresh in a folder of its own and reads the tables as they are.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.session import ensure_checkpoint_dir
from tidewatch.streaming.state import KeyedState

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                 "props STRING")
ORDERS_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                 "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
LINEITEM_SCHEMA = "l_orderkey BIGINT, l_suppkey BIGINT"
#: Bytes of input files that a micro-batch takes.
BATCH_BYTES = 4 << 30


def state_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the state of one run."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


def read_table_stream(spark: SparkSession, folder: str, table: str, schema: str,
                      max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """ST-01: a file stream over ``<folder>/<table>.<fmt>``, a file or a folder of part files.

    The path is given as a pattern, which the file source accepts for both.
    ``max_files`` limits a trigger by files instead of bytes.
    """
    limit = ("maxBytesPerTrigger", BATCH_BYTES) if max_files is None else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(schema).option(*limit).format(fmt).load(f"{folder.rstrip('/')}/{table}.{fmt[:-1]}[{fmt[-1]}]")


def station_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Events stream mapped to station readings (same rules as the batch binding)."""
    return station_rows(read_table_stream(spark, folder, "events", EVENTS_SCHEMA, max_files))


def station_rows(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("user_id").alias("station_id"), F.col("event_id").alias("obs_id"),
        F.col("ts").cast("timestamp").alias("time_utc"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") / F.lit(10.0)).alias("water_level"),
        F.col("event_type").alias("quality"),
    ).filter((F.col("station_id") % 10) != 9)


def dedupe(df: DataFrame, keys: list[str], time_col: str = "time_utc", delay: str | None = "1 hour") -> DataFrame:
    """ST-02: drop repeats of the declared key that arrive within the watermark (``delay=None``: at any time)."""
    if delay is None:
        return df.dropDuplicates(keys)
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def windowed_stats(df: DataFrame, length: str = "60 minutes", slide: str = "15 minutes",
                   delay: str | None = "1 hour") -> DataFrame:
    """ST-03: per station and sliding window: count, peak and mean level.

    ``delay=None`` keeps a watermark already defined upstream (e.g. by ``dedupe``);
    without one no row is dropped.
    """
    if delay is not None:
        df = df.withWatermark("time_utc", delay)
    return (df
            .groupBy("station_id", F.window("time_utc", length, slide).alias("w"))
            .agg(F.count("water_level").alias("obs_count"), F.max("water_level").alias("peak_value"),
                 F.avg("water_level").alias("mean_value"))
            .select("station_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "obs_count", "peak_value", "mean_value"))


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """One output partition per batch; a repeated batch replaces its own."""
    batch.write.mode("overwrite").parquet(os.path.join(path, f"_batch={batch_id}"))


def run_to_end(df: DataFrame, checkpoint: str, sink, mode: str = "append") -> None:
    """Run a stream over all input there is (availableNow) through ``sink(batch, batch_id)``."""
    q = (df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _next_version(root: str, spark: SparkSession) -> int:
    """One past the last batch the checkpoint has committed, to read the state as of now."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(os.path.join(root, "checkpoint", "commits"))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every key from an update-mode sink folder."""
    d = spark.read.parquet(path)
    cols = [c for c in d.columns if c not in keys and c != "_batch"]
    agg = d.groupBy(*keys).agg(F.max(F.struct("_batch", *cols)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def station_window_stats(spark: SparkSession, folder: str, state_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """ST-01 + ST-02 + ST-03 end to end; returns the final windowed table of all rows, files in any order.

    Repeated keys are dropped at any distance in time, so the key of every reading is in
    the state; ``dedupe`` with a delay bounds it where late repeats need not be found.
    """
    root = state_dir or state_folder(spark, "window-stats")
    out = os.path.join(root, "out")
    s = dedupe(station_stream(spark, folder, max_files), ["station_id", "obs_id"], delay=None)
    run_to_end(windowed_stats(s, delay=None), os.path.join(root, "checkpoint"),
               lambda batch, batch_id: write_batch(batch, batch_id, out), mode="update")
    return read_latest(spark, out, ["station_id", "window_start", "window_end"])


# --- ST-04: latest and previous reading ------------------------------------------------------

#: The two latest readings of a station, the latest first.
READINGS_STATE = ("station_id BIGINT, latest STRUCT<time_utc: TIMESTAMP, obs_id: BIGINT, water_level: DOUBLE>, "
                  "prev STRUCT<time_utc: TIMESTAMP, obs_id: BIGINT, water_level: DOUBLE>")


def merge_readings(rows: DataFrame, before: DataFrame) -> DataFrame:
    """The two latest readings of every station that ``rows`` names, over its rows and its state."""
    from tidewatch.operators.timeseries import latest_k
    cols = ["time_utc", "obs_id", "water_level"]
    top = latest_k(rows.select("station_id", *cols), 2).drop("rn")
    known = before.join(top.select("station_id").distinct(), "station_id", "left_semi")
    old = known.select("station_id", F.explode(F.array_compact(F.array("latest", "prev"))).alias("r")).select("station_id", "r.*")
    both = latest_k(top.unionByName(old).distinct(), 2)  # a repeated reading is one reading
    reading = F.struct(*cols)
    return both.groupBy("station_id").agg(F.max(F.when(F.col("rn") == 1, reading)).alias("latest"), F.max(F.when(F.col("rn") == 2, reading)).alias("prev"))


def station_scores(readings: DataFrame) -> DataFrame:
    """The two latest readings with the station's hazard from them (a single one is its own previous)."""
    from tidewatch.operators.timeseries import with_station_hazard
    from tidewatch.plans.stations import with_station_meta
    flat = readings.select("station_id", "latest", "prev", F.col("latest.time_utc").alias("latest_time_utc"), F.col("latest.water_level").alias("latest_water_level"),
                           F.coalesce(F.col("prev.time_utc"), F.col("latest.time_utc")).alias("prev_time_utc"),
                           F.when(F.col("prev").isNull(), F.col("latest.water_level")).otherwise(F.col("prev.water_level")).alias("prev_water_level"))
    return with_station_hazard(with_station_meta(flat))


def latest_state_stream(spark: SparkSession, folder: str, state_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """ST-04: latest and previous reading per station across micro-batches, scored; returns the final station table.

    A batch reads the state and writes the stations it names, nothing else.
    """
    root = state_dir or state_folder(spark, "latest-state")
    state = KeyedState(spark, os.path.join(root, "state"), ["station_id"], READINGS_STATE)

    def merge(batch: DataFrame, batch_id: int) -> None:
        state.compact(batch_id)
        state.write(merge_readings(batch, state.before(batch_id)), batch_id)

    run_to_end(station_stream(spark, folder, max_files), os.path.join(root, "checkpoint"), merge)
    return station_scores(state.before(_next_version(root, spark))).drop("latest", "prev")


# --- ST-05: rolling rescoring ------------------------------------------------------------------

STATION_STATE = READINGS_STATE + ", hazard DOUBLE"
AREA_STATE = ("area_id BIGINT, swh DOUBLE, sw DOUBLE, n BIGINT, near_max DOUBLE, near_n BIGINT, up DOUBLE, zero BOOLEAN, down DOUBLE")
CLOCK_STATE = "feed STRING, at TIMESTAMP"


def rolling_indices(spark: SparkSession, folder: str, phase: str = C.DEFAULT_PHASE, state_dir: str | None = None,
                    max_files: int | None = None) -> DataFrame:
    """ST-05: ``scored_indices`` kept up to date by a stream of events; returns the rows after the last batch.

    Kept per area: sum of weight * hazard and of weights over all stations, largest
    hazard and number of the near ones, and the running maximum of the events'
    log intensity + time / decay (see ``operators.replay``).  A batch

    * merges its readings into the state of the stations it names (ST-04);
    * adds, per area, the weighted difference that these stations make;
    * takes the largest near hazard anew for the areas near one of them, since a
      maximum cannot be taken back;
    * adds its events to the earthquake maximum;
    * writes the changed rows, and the areas' scores as ``out/_batch=<n>``.

    Area features and the alert score are tables that are read when the stream
    starts.  Raw rows are seen once.
    """
    from tidewatch.operators.alerts import alert_score, global_alert_score
    from tidewatch.plans.areas import area_features
    from tidewatch.session import stage_checkpoint
    from tidewatch.sources import bind
    root = state_dir or state_folder(spark, "rolling-indices")
    out = os.path.join(root, "out")
    feats = area_features(spark, folder)
    # alerts have a feed and a run time of their own
    override = stage_checkpoint(spark.range(1).select(global_alert_score(alert_score(bind.active_alerts(spark, folder))).alias("g")), "rolling_alert").select("g").scalar()
    stations = KeyedState(spark, os.path.join(root, "stations"), ["station_id"], STATION_STATE)
    areas = KeyedState(spark, os.path.join(root, "areas"), ["area_id"], AREA_STATE)
    clock = KeyedState(spark, os.path.join(root, "clock"), ["feed"], CLOCK_STATE)

    def rescore(batch: DataFrame, batch_id: int) -> None:
        for state in (stations, areas, clock):
            state.compact(batch_id)
        _rescore_batch(batch, batch_id, feats, override, stations, areas, clock, phase).write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))

    run_to_end(read_table_stream(spark, folder, "events", EVENTS_SCHEMA, max_files), os.path.join(root, "checkpoint"), rescore)
    last = _next_version(root, spark) - 1
    if last < 0:  # no event has come
        return _area_scores(feats, areas.before(0), clock.before(0), override, phase)
    return spark.read.parquet(os.path.join(out, f"_batch={last}"))


def _rescore_batch(batch: DataFrame, batch_id: int, feats: DataFrame, override, stations: KeyedState, areas: KeyedState, clock: KeyedState,
                   phase: str) -> DataFrame:
    from tidewatch.functions.geo import depth_factor, distance_attenuation
    from tidewatch.functions.numeric import clip
    from tidewatch.operators.spatial import kernel_pairs, radius_join
    from tidewatch.sources.bind import quake_rows
    batch = batch.persist()  # read by the readings, the events and the clock
    try:
        located = feats.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("area_id", "latitude", "longitude")
        old_stations, old = stations.before(batch_id), areas.before(batch_id)
        now = station_scores(merge_readings(station_rows(batch), old_stations.drop("hazard")))
        hazard = F.greatest(clip("sensor_hazard_score", 0.0, 100.0), override.cast("double"))
        changed = stations.write(now.select("station_id", "latest", "prev", hazard.alias("hazard")), batch_id)

        def places(rows: DataFrame) -> DataFrame:
            from tidewatch.plans.stations import with_station_meta
            return with_station_meta(rows.select("station_id", "hazard")).select("station_id", "lat", "lon", "hazard")

        before = old_stations.select("station_id", F.col("hazard").alias("was"))
        moved = places(changed).join(before, "station_id", "left").groupBy("lat", "lon").agg(
            F.sum(F.col("hazard") - F.coalesce("was", F.lit(0.0))).alias("dh"), F.count_if(F.col("was").isNull()).alias("dn"))
        w = F.exp(-F.col("_d") / F.lit(float(C.LAMBDA_KM)))
        flood = kernel_pairs(located, moved, "area_id").groupBy("area_id").agg(
            F.sum(w * F.col("dh")).alias("d_swh"), F.sum(w * F.col("dn")).alias("d_sw"), F.sum("dn").alias("d_n"))

        reach = lambda left, right: radius_join(left, right, C.OVERRIDE_KM)
        touched = reach(located, moved.select("lat", "lon")).select("area_id").distinct()
        every = places(stations.before(batch_id + 1))
        near = reach(located.join(touched, "area_id", "left_semi"), every).groupBy("area_id").agg(F.max("hazard").alias("t_max"), F.count(F.lit(1)).alias("t_n"))

        q = quake_rows(batch).filter(F.col("time_utc").isNotNull())
        f = F.coalesce(F.col("magnitude"), F.lit(0.0)) * depth_factor("depth_km")
        x = F.log(F.abs(F.col("_f"))) + F.unix_micros(F.col("time_utc").cast("timestamp")) / F.lit(3.6e9 * C.EQ_RECENCY_HOURS)
        q = q.select("latitude", "longitude", "time_utc", f.alias("_f")).groupBy(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).agg(
            F.max(F.when(F.col("_f") > 0, x)).alias("b_up"), F.max(F.col("_f") == 0).alias("b_zero"), F.min(F.when(F.col("_f") < 0, x)).alias("b_down"))
        far = F.log(distance_attenuation(F.col("_d")))
        quake = kernel_pairs(located, q.filter("lat IS NOT NULL AND lon IS NOT NULL"), "area_id").groupBy("area_id").agg(
            F.max(F.col("b_up") - far).alias("b_up"), F.max("b_zero").alias("b_zero"), F.min(F.col("b_down") - far).alias("b_down"))

        zero = F.lit(0.0)
        d = located.select("area_id").join(old, "area_id", "left")
        for part in (flood, near, quake):
            d = d.join(part, "area_id", "left")
        d = d.select(
            "area_id", (F.coalesce("swh", zero) + F.coalesce("d_swh", zero)).alias("swh"), (F.coalesce("sw", zero) + F.coalesce("d_sw", zero)).alias("sw"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("d_n", F.lit(0))).alias("n"), F.when(F.col("t_n").isNotNull(), F.col("t_max")).otherwise(F.col("near_max")).alias("near_max"),
            F.coalesce("t_n", "near_n", F.lit(0)).alias("near_n"), F.greatest("up", "b_up").alias("up"), F.greatest("zero", "b_zero").alias("zero"),
            F.least("down", "b_down").alias("down"))
        areas.write(d, batch_id)

        times = batch.agg(F.max(F.col("ts").cast("timestamp")).alias("events"), F.lit(None).cast("timestamp").alias("readings"))
        seen = changed.agg(F.max("latest.time_utc").alias("readings"), F.lit(None).cast("timestamp").alias("events"))
        new = times.unionByName(seen).unpivot([], ["events", "readings"], "feed", "at")
        clock.write(clock.before(batch_id).unionByName(new).groupBy("feed").agg(F.max("at").alias("at")), batch_id)
    finally:
        batch.unpersist()
    return _area_scores(feats, areas.before(batch_id + 1), clock.before(batch_id + 1), override, phase)


def _area_scores(feats: DataFrame, state: DataFrame, clock: DataFrame, override, phase: str) -> DataFrame:
    """The scores that the batch pipeline gives, from the area state."""
    from tidewatch.operators import scoring as sc
    time_of = lambda feed: clock.filter(F.col("feed") == feed).select(F.max("at")).scalar()
    d = feats.join(state, "area_id").withColumns({"_now": time_of("events"), "noaa_latest_obs_utc": time_of("readings")})
    age = F.unix_micros("_now") / F.lit(3.6e9 * C.EQ_RECENCY_HOURS)
    raw = (F.when(F.col("up").isNotNull(), F.exp(F.col("up") - age)).when(F.col("zero"), F.lit(0.0))
           .when(F.col("down").isNotNull(), -F.exp(F.col("down") - age)))
    d = d.withColumns({"nws_global_alert_score": override.cast("double"), "earthquake_raw": raw})
    d = d.withColumn("flood_hazard_muni", F.greatest(F.try_divide("swh", "sw"), F.col("near_max"), F.col("nws_global_alert_score")))
    d = sc.robust_score(d, "earthquake_raw", "earthquake_hazard_score")
    d = d.withColumn("earthquake_hazard_score", F.coalesce("earthquake_hazard_score", F.lit(0.0)))
    d = d.withColumn("hazard_combined", F.greatest("flood_hazard_muni", "earthquake_hazard_score"))
    d = sc.with_confidence(sc.with_operational_indices(d, phase), F.col("_now"))
    d = sc.with_bands(sc.with_confidence_adjustment(d))
    return d.select("area_id", *sc.SCORED_COLUMNS, "nws_global_alert_score")


# --- ST-06: alert sessions --------------------------------------------------------------------

def alert_sessions(spark: SparkSession, folder: str, gap_hours: float = 24.0, state_dir: str | None = None, max_files: int | None = None) -> DataFrame:
    """ST-06: per zone, sessions of alert onsets separated by at least ``gap_hours``.

    Alerts and their zones are two streams; each side's rows are kept, so a pair
    counts from the batch on that completes it, whichever side came first, and only
    once.  New pairs are merged into the sessions of their zones
    (``sessions.merge_sessions``); other zones are not read again.
    """
    from tidewatch.operators.sessions import merge_sessions
    from tidewatch.sources.bind import zone_rows
    root = state_dir or state_folder(spark, "sessions")
    alerts = KeyedState(spark, os.path.join(root, "alerts"), ["alert_key"], "alert_key BIGINT, onset TIMESTAMP")
    zones = KeyedState(spark, os.path.join(root, "zones"), ["alert_key", "zone_id"], "alert_key BIGINT, zone_id STRING")
    sessions = KeyedState(spark, os.path.join(root, "sessions"), ["zone_id"], "zone_id STRING, sessions ARRAY<STRUCT<first: BIGINT, last: BIGINT, n: BIGINT>>")
    none = F.lit(None)
    o = read_table_stream(spark, folder, "orders", ORDERS_SCHEMA, max_files).select(
        F.col("o_orderkey").alias("alert_key"), F.col("o_orderdate").cast("timestamp").alias("onset"), none.cast("string").alias("zone_id"))
    z = zone_rows(read_table_stream(spark, folder, "lineitem", LINEITEM_SCHEMA, max_files)).select("alert_key", none.cast("timestamp").alias("onset"), "zone_id")

    def merge(batch: DataFrame, batch_id: int) -> None:
        for state in (alerts, zones, sessions):
            state.compact(batch_id)
        old_alerts, old_zones, old = (state.before(batch_id) for state in (alerts, zones, sessions))
        key = ["alert_key"]
        new_alerts = alerts.write(batch.filter("onset IS NOT NULL").groupBy("alert_key").agg(F.min("onset").alias("onset")).join(old_alerts, key, "left_anti"), batch_id)
        new_zones = zones.write(batch.filter("zone_id IS NOT NULL").select("alert_key", "zone_id").distinct().join(old_zones, ["alert_key", "zone_id"], "left_anti"), batch_id)
        pairs = new_alerts.join(new_zones.unionByName(old_zones), key).unionByName(old_alerts.join(new_zones, key))
        points = pairs.groupBy("zone_id", F.unix_micros("onset").alias("first")).agg(F.count(F.lit(1)).alias("n")).withColumn("last", F.col("first"))
        kept = old.join(points.select("zone_id").distinct(), "zone_id", "left_semi").select("zone_id", F.explode("sessions").alias("s")).select("zone_id", "s.*")
        merged = merge_sessions(kept.unionByName(points), ["zone_id"], gap_hours)
        sessions.write(merged.groupBy("zone_id").agg(F.collect_list(F.struct("first", "last", "n")).alias("sessions")), batch_id)

    run_to_end(o.unionByName(z), os.path.join(root, "checkpoint"), merge)
    s = sessions.before(_next_version(root, spark)).select("zone_id", F.explode("sessions").alias("s"))
    return s.select("zone_id", F.timestamp_micros("s.first").alias("session_start"),
                    F.timestamp_micros(F.col("s.last") + F.lit(int(gap_hours * 3_600_000_000))).alias("session_end"), F.col("s.n").alias("n_alerts"))
