"""Streams over folders of part files: any order, restart, same result as the batch query."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidewatch.plans.registry import QUERIES
from tidewatch.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def folder(spark, path, order, first=True):
    """events and orders in two part files each; ``order`` says which half is older as a file."""
    for t, col in (("events", "ts"), ("orders", "o_orderdate")):
        d = spark.read.parquet(f"{SF}/{t}.parquet")
        mid = d.select(F.percentile(F.unix_micros(F.col(col).cast("timestamp")), 0.5)).first()[0]
        early = F.unix_micros(F.col(col).cast("timestamp")) <= mid
        os.makedirs(f"{path}/{t}.parquet", exist_ok=True)
        for k, half in enumerate(order):
            if (k == 0) != first and first is not None:
                continue
            tmp = f"{path}/_{t}{k}"
            d.filter(early if half == "early" else ~early).coalesce(1).write.parquet(tmp)
            part = next(f for f in os.listdir(tmp) if f.startswith("part-"))
            target = f"{path}/{t}.parquet/some-name-{k}.parquet"
            shutil.copyfile(f"{tmp}/{part}", target)
            os.utime(target, (1_700_000_000 + k * 100, 1_700_000_000 + k * 100))
    for t in ("lineitem", "supplier", "nation", "customer"):
        if not os.path.exists(f"{path}/{t}.parquet"):
            os.symlink(f"{SF}/{t}.parquet", f"{path}/{t}.parquet")
    return str(path)


def rows(df):
    return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in df.collect())


@pytest.mark.parametrize("order", [("early", "late"), ("late", "early")])
def test_sessions_and_latest_state_equal_one_file_in_any_order(spark, tmp_path, order):
    f = folder(spark, tmp_path, order, first=None)
    cols = ["station_id", "latest_time_utc", "latest_water_level", "prev_time_utc", "prev_water_level", "sensor_hazard_score"]
    assert rows(ST.alert_sessions(spark, f, max_files=1)) == rows(ST.alert_sessions(spark, SF))
    assert rows(ST.latest_state_stream(spark, f, max_files=1).select(cols)) == rows(ST.latest_state_stream(spark, SF).select(cols))


def test_window_stats_on_a_folder_in_time_order(spark, tmp_path):
    f = folder(spark, tmp_path, ("early", "late"), first=None)
    cols = ["station_id", "window_start", "window_end", "obs_count", "peak_value", "mean_value"]
    got = ST.station_window_stats(spark, f, max_files=1).select(cols)
    assert rows(got) == rows(ST.station_window_stats(spark, SF).select(cols))


@pytest.mark.parametrize("order", [("early", "late"), ("late", "early")])
def test_window_stats_of_part_files_in_any_order(spark, tmp_path, order):
    f = folder(spark, tmp_path, order, first=None)
    for k in (0, 1):  # every reading again, in a later file
        shutil.copyfile(f"{f}/events.parquet/some-name-{k}.parquet", f"{f}/events.parquet/again-{k}.parquet")
        os.utime(f"{f}/events.parquet/again-{k}.parquet", (1_700_001_000 + k * 100,) * 2)
    want = ST.station_stream(spark, SF).schema
    batch = spark.read.parquet(f"{SF}/events.parquet").filter("user_id % 10 != 9").selectExpr(
        "user_id AS station_id", "event_id AS obs_id", "CAST(ts AS TIMESTAMP) AS time_utc",
        "CASE WHEN event_id % 17 != 0 THEN value / 10.0D END AS water_level", "event_type AS quality")
    assert batch.columns == want.names
    got = ST.station_window_stats(spark, f, max_files=1)
    assert rows(got) == rows(ST.windowed_stats(batch, delay=None).select(got.columns))
    assert rows(QUERIES["stream_window_stats"](spark, f)) == rows(QUERIES["stream_window_stats"](spark, SF))


def test_restart_continues_and_repeated_runs_change_nothing(spark, tmp_path):
    data, state = tmp_path / "data", tmp_path / "state"
    folder(spark, data, ("early", "late"), first=True)
    cols = ["station_id", "latest_time_utc", "latest_water_level", "prev_time_utc", "prev_water_level"]
    half = ST.alert_sessions(spark, str(data), state_dir=f"{state}/s").count()
    ST.latest_state_stream(spark, str(data), state_dir=f"{state}/l")
    folder(spark, data, ("early", "late"), first=False)  # the second file arrives
    for _ in range(2):
        sessions = ST.alert_sessions(spark, str(data), state_dir=f"{state}/s")
        latest = ST.latest_state_stream(spark, str(data), state_dir=f"{state}/l")
        assert rows(sessions) == rows(ST.alert_sessions(spark, SF))
        assert rows(latest.select(cols)) == rows(ST.latest_state_stream(spark, SF).select(cols))
    assert half < sessions.count()


def test_repeated_rows_are_dropped(spark, tmp_path):
    f = folder(spark, tmp_path, ("early", "late"), first=None)
    for k in (0, 1):
        shutil.copyfile(f"{f}/events.parquet/some-name-{k}.parquet", f"{f}/events.parquet/again-{k}.parquet")
        os.utime(f"{f}/events.parquet/again-{k}.parquet", (1_700_000_000 + k * 100,) * 2)
    cols = ["station_id", "window_start", "obs_count"]
    assert rows(ST.station_window_stats(spark, f).select(cols)) == rows(ST.station_window_stats(spark, SF).select(cols))


def test_a_missing_state_is_an_error(spark, tmp_path):
    data, state = tmp_path / "data", tmp_path / "state"
    folder(spark, data, ("early", "late"), first=True)
    ST.latest_state_stream(spark, str(data), state_dir=str(state))
    os.rename(f"{state}/state", f"{state}/elsewhere")
    folder(spark, data, ("early", "late"), first=False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ST.latest_state_stream(spark, str(data), state_dir=str(state))


def test_registered_streams_read_part_files(spark, tmp_path):
    f = folder(spark, tmp_path, ("early", "late"), first=None)
    assert rows(QUERIES["stream_latest_state"](spark, f)) == rows(QUERIES["stream_latest_state"](spark, SF))


# --- results follow the data ---------------------------------------------------------------------

def test_a_replaced_table_and_an_added_part_file_are_read(spark, tmp_path):
    """The registered queries take the tables as they are, a second time too."""
    f = folder(spark, tmp_path / "a", ("early", "late"), first=True)
    names = ["stream_latest_state", "stream_window_stats", "stream_alert_sessions"]
    half = {n: rows(QUERIES[n](spark, f)) for n in [*names, "quality_value_counts"]}
    folder(spark, tmp_path / "a", ("early", "late"), first=False)  # a part file more
    for n in half:
        again = rows(QUERIES[n](spark, f))
        assert again == rows(QUERIES[n](spark, SF)) and again != half[n]
    other = tmp_path / "b"
    other.mkdir()
    events = spark.read.parquet(f"{SF}/events.parquet")
    for factor in (1.0, 3.0):
        events.withColumn("value", F.col("value") * factor).write.mode("overwrite").parquet(f"{other}/events.parquet")
        got = QUERIES["stream_latest_state"](spark, str(other)).agg(F.sum("latest_water_level")).first()[0]
        want = QUERIES["stream_latest_state"](spark, SF).agg(F.sum("latest_water_level")).first()[0]
        assert abs(got - factor * want) < 1e-6


def split_file(spark, path, table, halves):
    """A table as part files, each holding the rows of one condition, in that order of time."""
    d = spark.read.parquet(f"{SF}/{table}.parquet")
    os.makedirs(f"{path}/{table}.parquet", exist_ok=True)
    for k, cond in halves:
        tmp = f"{path}/_{table}{k}"
        d.filter(cond).coalesce(1).write.parquet(tmp)
        target = f"{path}/{table}.parquet/part-{k}.parquet"
        shutil.copyfile(f"{tmp}/" + next(x for x in os.listdir(tmp) if x.startswith("part-")), target)
        os.utime(target, (1_700_000_000 + k * 100,) * 2)


@pytest.mark.parametrize("max_files", [None, 1])
def test_late_line_items_join_alerts_that_came_before(spark, tmp_path, max_files):
    even = F.col("l_orderkey") % 2 == 0
    os.symlink(f"{SF}/orders.parquet", f"{tmp_path}/orders.parquet")
    split_file(spark, tmp_path, "lineitem", [(0, even)])
    half = ST.alert_sessions(spark, str(tmp_path), state_dir=f"{tmp_path}/state", max_files=max_files)
    half = half.agg(F.sum("n_alerts")).first()[0]
    split_file(spark, tmp_path, "lineitem", [(1, ~even)])
    whole = ST.alert_sessions(spark, str(tmp_path), state_dir=f"{tmp_path}/state", max_files=max_files)
    assert rows(whole) == rows(ST.alert_sessions(spark, SF))
    assert whole.agg(F.sum("n_alerts")).first()[0] > half
    # the same files once more add nothing
    split_file(spark, tmp_path / "x", "lineitem", [(2, even)])
    shutil.copyfile(f"{tmp_path}/x/lineitem.parquet/part-2.parquet", f"{tmp_path}/lineitem.parquet/part-2.parquet")
    assert rows(ST.alert_sessions(spark, str(tmp_path), state_dir=f"{tmp_path}/state", max_files=max_files)) == rows(whole)


SCORED = ["area_id", "hazard_combined", "flood_hazard_muni", "earthquake_hazard_score", "risk_index_raw", "priority_index", "priority_index_conf_adj",
          "confidence_score", "priority_band", "nws_global_alert_score"]


@pytest.mark.parametrize("order", [("early", "late"), ("late", "early")])
def test_rolling_indices_equal_the_batch_after_every_batch(spark, tmp_path, order):
    from tidewatch.plans.areas import scored_indices
    f = folder(spark, tmp_path, order, first=None)
    orders = f"{tmp_path}/orders.parquet"
    shutil.rmtree(orders)
    os.symlink(f"{SF}/orders.parquet", orders)  # alerts are a table here
    got = ST.rolling_indices(spark, f, state_dir=f"{tmp_path}/state", max_files=1)
    assert rows(got.select(SCORED)) == rows(scored_indices(spark, SF).select(SCORED))
    first = tmp_path / "first"  # what the batch pipeline gives on the first file alone
    (first / "events.parquet").mkdir(parents=True)
    shutil.copyfile(f"{f}/events.parquet/some-name-0.parquet", first / "events.parquet" / "a.parquet")
    for t in ("orders", "lineitem", "supplier", "nation", "customer"):
        os.symlink(f"{SF}/{t}.parquet", first / f"{t}.parquet")
    after_first = spark.read.parquet(f"{tmp_path}/state/out/_batch=0")
    assert rows(after_first.select(SCORED)) == rows(scored_indices(spark, str(first)).select(SCORED))
    if order[0] == "early":  # late readings and events leave nothing for the early ones to change
        assert rows(after_first.select(SCORED)) != rows(got.select(SCORED))
    # started again without new files: the same rows
    assert rows(ST.rolling_indices(spark, f, state_dir=f"{tmp_path}/state", max_files=1).select(SCORED)) == rows(got.select(SCORED))


def test_state_holds_changed_keys_only_and_is_compacted(spark, tmp_path):
    from tidewatch.streaming.state import KeyedState
    s = KeyedState(spark, f"{tmp_path}/s", ["k"], "k BIGINT, v STRING", compact_after=3)
    want = {}
    for version in range(11):
        s.compact(version)
        assert {r.k: r.v for r in s.before(version).collect()} == want
        changed = {version % 4: f"v{version}", 100 + version: "new"} if version != 5 else {}
        for _ in range(2):  # a batch that runs again replaces its own version
            assert s.write(spark.createDataFrame(list(changed.items()), "k BIGINT, v STRING"), version).count() == len(changed)
        want |= changed
        assert s.size()[0] <= 4
    assert {r.k: r.v for r in s.before(11).collect()} == want
    with pytest.raises(FileNotFoundError, match="does not exist"):
        s.before(13)


def test_merged_sessions_equal_brute_force(spark):
    import random

    from tidewatch.operators.sessions import merge_sessions
    r = random.Random(2)
    hour = 3_600_000_000
    points = [(r.choice("aaab"), r.randint(0, 400) * hour // 2 + r.choice([0, 1, -1])) for _ in range(300)] + [("c", 0), ("c", 24 * hour), ("d", 0), ("d", 24 * hour - 1)]
    want = []
    for z in "abcd":
        run = []
        for t in sorted(t for y, t in points if y == z):
            if run and t - run[-1] >= 24 * hour:
                want.append((z, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        want.append((z, run[0], run[-1], len(run)))
    df = spark.createDataFrame([(z, t, t, 1) for z, t in points], "zone_id string, first long, last long, n long").repartition(4)
    one, two = df.filter("first % 7 < 3"), df.filter("first % 7 >= 3")
    assert sorted(map(tuple, merge_sessions(df, ["zone_id"], 24.0).collect())) == sorted(want)
    step = merge_sessions(one, ["zone_id"], 24.0).unionByName(two)  # sessions so far and new points
    assert sorted(map(tuple, merge_sessions(step, ["zone_id"], 24.0).collect())) == sorted(want)
