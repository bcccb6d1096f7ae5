"""ST-04 on the state API: the batch query's rows, a restart, state size and idle timers."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_streams import SF, folder, rows

from tidewatch.streaming import streams as ST
from tidewatch.streaming.stateful import latest_state_by_store

COLS = ["station_id", "latest_time_utc", "latest_water_level", "prev_time_utc", "prev_water_level", "sensor_hazard_score"]


@pytest.mark.parametrize("order", [("early", "late"), ("late", "early")])
def test_rows_equal_the_table_state_and_a_restart_continues(spark, tmp_path, order):
    data, state = tmp_path / "data", str(tmp_path / "state")
    folder(spark, data, order, first=True)
    half = latest_state_by_store(spark, str(data), state_dir=state, max_files=1)
    assert rows(half.select(COLS)) == rows(ST.latest_state_stream(spark, str(data)).select(COLS))
    folder(spark, data, order, first=False)
    whole = latest_state_by_store(spark, str(data), state_dir=state, max_files=1)
    assert rows(whole.select(COLS)) == rows(ST.latest_state_stream(spark, SF).select(COLS))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0  # the setting is put back
    kept = spark.read.format("statestore").option("stateVarName", "readings").load(f"{state}/checkpoint")
    assert kept.count() <= 2 * whole.count()  # two readings per station


def test_idle_stations_are_closed(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    events = [(1, start, 1), (2, start + dt.timedelta(hours=1), 1), (3, start + dt.timedelta(hours=2), 2), (4, start + dt.timedelta(hours=300), 2)]
    os.makedirs(f"{tmp_path}/events.parquet")
    for k, part in enumerate((events[:3], events[3:], [(5, start + dt.timedelta(hours=301), 2)])):
        tmp = f"{tmp_path}/_{k}"
        spark.createDataFrame([(i, t, u, "x", 10.0, "{}") for i, t, u in part], ST.EVENTS_SCHEMA).coalesce(1).write.parquet(tmp)
        name = next(x for x in os.listdir(tmp) if x.startswith("part-"))
        os.rename(f"{tmp}/{name}", f"{tmp_path}/events.parquet/{k}.parquet")
        os.utime(f"{tmp_path}/events.parquet/{k}.parquet", (1_700_000_000 + k * 100,) * 2)
    got = {r.station_id: r for r in latest_state_by_store(spark, str(tmp_path), max_files=1, idle_hours=48).collect()}
    assert got[1].closed and got[1].latest_time_utc == start + dt.timedelta(hours=1) and got[1].prev_time_utc == start
    assert not got[2].closed and got[2].latest_time_utc == start + dt.timedelta(hours=301)
    kept = latest_state_by_store(spark, str(tmp_path), max_files=1)
    assert not kept.filter(F.col("closed")).count() and kept.count() == 2
