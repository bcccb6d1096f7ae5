"""ST-04 with Spark's state API: the two latest readings of a station in keyed list state.

``streams.latest_state_stream`` keeps the same state in a table and needs no Python
worker; it stays the default.  Here Spark's state store holds it: per station two
readings (latest first, 24 bytes each and the store's overhead), so the state grows
with the number of stations, never with their readings.  A batch reads and writes
only the stations that it names; nothing else is rewritten.

With ``idle_hours`` an event-time timer closes a station that has been silent for so
long behind the watermark: its last row is emitted with ``closed`` and its state
is dropped.  Without it (the default) no timer is set and every station is kept.
"""
from __future__ import annotations

import contextlib
import datetime as dt
import os
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch.streaming.streams import read_latest, run_to_end, state_folder, station_scores, station_stream, write_batch

READING = "time_utc TIMESTAMP, obs_id BIGINT, water_level DOUBLE"
OUT = ("station_id BIGINT, time_utc TIMESTAMP, obs_id BIGINT, water_level DOUBLE, prev_time_utc TIMESTAMP, prev_obs_id BIGINT, "
       "prev_water_level DOUBLE, closed BOOLEAN")
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestTwo(StatefulProcessor):
    """Keeps a station's two latest readings by (time, id); a repeated reading counts once."""

    def __init__(self, idle_hours: float | None = None) -> None:
        self.idle_ms = None if idle_hours is None else int(idle_hours * 3_600_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", READING)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kept = {(r[0], r[1]): r[2] for r in self.readings.get()} if self.readings.exists() else {}
        for part in rows:
            # each part can add two readings at most
            part = part.sort_values(["time_utc", "obs_id"]).drop_duplicates(["time_utc", "obs_id"], keep="last").tail(2)
            for t, o, v in zip(part["time_utc"], part["obs_id"], part["water_level"]):
                kept[t.to_pydatetime(), int(o)] = None if pd.isna(v) else float(v)
        top = sorted(kept.items(), reverse=True)[:2]
        self.readings.put([(t, o, v) for (t, o), v in top])
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(top[0][0][0].replace(tzinfo=dt.timezone.utc).timestamp() * 1000) + self.idle_ms)
        yield self._row(key, top, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        top = [((r[0], r[1]), r[2]) for r in self.readings.get()]
        self.readings.clear()
        yield self._row(key, top, True)

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key: Any, top: list, closed: bool) -> pd.DataFrame:
        (t, o), v = top[0]
        (pt, po), pv = top[1] if len(top) > 1 else ((None, None), None)
        d = pd.DataFrame({"station_id": [key[0]], "time_utc": pd.Series([t], dtype="datetime64[us]"), "obs_id": [o],
                          "water_level": pd.Series([v], dtype="float64"), "prev_time_utc": pd.Series([pt], dtype="datetime64[us]"),
                          "prev_obs_id": pd.Series([po], dtype="Int64"), "prev_water_level": pd.Series([pv], dtype="float64"), "closed": [closed]})
        return d


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def latest_state_by_store(spark: SparkSession, folder: str, state_dir: str | None = None, max_files: int | None = None,
                          idle_hours: float | None = None, lateness: str = "0 seconds") -> DataFrame:
    """ST-04: latest and previous reading per station from the state store, scored; ``closed`` marks stations given up.

    ``lateness`` is the watermark's delay and matters with ``idle_hours`` only.
    """
    root = state_dir or state_folder(spark, "latest-store")
    out = os.path.join(root, "out")
    s = station_stream(spark, folder, max_files).select("station_id", "time_utc", "obs_id", "water_level")
    if idle_hours is not None:
        s = s.withWatermark("time_utc", lateness)
    rows = s.groupBy("station_id").transformWithStateInPandas(LatestTwo(idle_hours), OUT, "Update", "none" if idle_hours is None else "eventTime")
    with _setting(spark, PROVIDER, ROCKSDB):
        run_to_end(rows, os.path.join(root, "checkpoint"), lambda batch, batch_id: write_batch(batch, batch_id, out), mode="update")
    newest = read_latest(spark, out, ["station_id"])
    prev = F.struct(F.col("prev_time_utc").alias("time_utc"), F.col("prev_obs_id").alias("obs_id"), F.col("prev_water_level").alias("water_level"))
    readings = newest.select("station_id", F.struct("time_utc", "obs_id", "water_level").alias("latest"),
                             F.when(F.col("prev_time_utc").isNotNull(), prev).alias("prev"))
    return station_scores(readings).drop("latest", "prev").join(newest.select("station_id", "closed"), "station_id")
