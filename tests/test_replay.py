"""Replays: the timeline sweep against brute force, states and indices at steps against the batch pipeline."""
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import replay as rp
from tidewatch.operators.timeseries import latest_and_previous
from tidewatch.plans import areas as A
from tidewatch.plans import replay as R
from tidewatch.sources import bind

SF = "/root/testdata/sf0.001"
UTC = dt.timezone.utc


def sweep(rows, lo, hi):
    out = {}
    for z, b, e, level in rows:
        if b is not None and level is not None:
            for s in range(max(b, lo), (hi if e is None else min(e - 1, hi)) + 1):
                top, n = out.get((z, s), (0, 0))
                out[z, s] = (max(top, level), n + 1)
    return out


def test_timeline_equals_brute_force(spark):
    """Overlapping, touching, endless, empty and reversed intervals, some before and after the range; one hot zone."""
    r = random.Random(3)
    rows = [("a", -9, -5, 40), ("a", -5, -2, 70), ("a", -7, -3, 70), ("b", -20, None, 25), ("b", -4, None, 100), ("c", -3, -3, 80), ("c", -2, -6, 80),
            ("d", None, -1, 60), ("e", 3, 9, 60), ("f", -30, -12, 60), ("g", -1, 5, 60), ("h", -4, -2, None), (None, -3, 1, 40)]
    rows += [("hot" if k % 3 else f"z{k % 50}", b := r.randint(-15, 0), r.choice([None, b + r.randint(0, 6)]), r.choice([25, 40, 70, 100])) for k in range(3_000)]
    df = spark.createDataFrame(rows, "zone_id string, begin long, end long, level int").repartition(5)
    got = rp.level_timeline(df, ["zone_id"], F.lit(-10)).collect()
    assert {(x.zone_id, x.step): (x.level, x.n_active) for x in got} == sweep(rows, -10, 0)
    every = rp.level_timeline(df, [], F.lit(-10)).collect()
    assert {(None, x.step): (x.level, x.n_active) for x in every} == sweep([(None, *x[1:]) for x in rows], -10, 0)
    assert rp.level_timeline(df.filter("false"), ["zone_id"], F.lit(-10)).count() == 0


def test_a_hot_zone_ships_few_rows(spark):
    """Events of one zone are summed before the shuffle: its window holds one row per level and step."""
    df = spark.range(200_000).select(F.lit("z").alias("zone_id"), (-(F.col("id") % 20)).alias("begin"), F.lit(None).cast("long").alias("end"),
                                     (F.col("id") % 3).alias("level"))
    plan = rp.level_timeline(df, ["zone_id"], F.lit(-19))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate", plan.index("Window"))  # the window reads an aggregate
    got = {x.step: x.n_active for x in rp.level_timeline(df, ["zone_id"], F.lit(-19)).collect()}
    assert got == {-k: 200_000 * (20 - k) // 20 for k in range(20)}


def test_steps_of_times(spark):
    as_of = dt.datetime(2024, 3, 1, 12, 0, 0, 500)
    cases = [(as_of, 0), (as_of - dt.timedelta(microseconds=1), 0), (as_of - dt.timedelta(hours=6), -1), (as_of - dt.timedelta(hours=6, microseconds=1), -1),
             (as_of - dt.timedelta(hours=12), -2), (as_of + dt.timedelta(microseconds=1), 1), (as_of + dt.timedelta(hours=6), 1), (None, None)]
    df = spark.createDataFrame([(t, s) for t, s in cases], "t timestamp_ntz, want long")
    at = F.lit(as_of).cast("timestamp_ntz")
    for r in df.select("want", rp.step_of(F.col("t"), at, 6).alias("step"), "t", rp.step_time(rp.step_of(F.col("t"), at, 6), at, 6).cast("timestamp_ntz").alias("u")).collect():
        assert r.step == r.want
        assert r.t is None or dt.timedelta(0) <= r.u - r.t < dt.timedelta(hours=6)


def test_station_states_equal_the_batch_operator_at_every_step(spark):
    r = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(s := r.choice([1, 1, 1, 2, 3, 4]), k, start + dt.timedelta(hours=r.choice([0, 24, 30, 31, 90, 240]) + (200 if s == 4 else 0)),
             r.choice([None, r.random()])) for k in range(60)] + [(9, 1_000, start, 1.5)]
    as_of = start + dt.timedelta(hours=440)
    s = spark.createDataFrame(rows, "station_id long, obs_id long, time_utc timestamp, water_level double")
    at = F.lit(as_of)
    got = rp.latest_by_step(s.withColumn("step", rp.step_of(F.col("time_utc"), at, 24))).collect()
    by = {}
    for x in got:
        by.setdefault(x.step, set()).add(tuple(x[c] for c in x.__fields__ if c != "step"))
    for step in range(-19, 1):
        t = as_of + dt.timedelta(hours=24 * step)
        want = {tuple(x) for x in latest_and_previous(s.filter(F.col("time_utc") <= F.lit(t))).collect()}
        assert by.get(step, set()) == want, step


def test_decay_maximum_equals_direct(spark):
    """Positive, zero, negative and missing magnitudes, several events at one place."""
    r = random.Random(7)
    as_of = dt.datetime(2024, 2, 1)
    quakes = [(18 + r.randint(0, 4) / 10, -66 - r.randint(0, 3) / 10, r.choice([None, 0.0, 1.0, 3.5, 6.0]), r.choice([None, 10.0, 90.0]),
               as_of - dt.timedelta(hours=r.randint(0, 300))) for _ in range(60)]
    only_low = [(18.2, -66.1, -1.5, 10.0, as_of - dt.timedelta(hours=240)), (18.2, -66.3, -0.5, 10.0, as_of - dt.timedelta(hours=100))]
    areas = spark.createDataFrame([(1, 18.1, -66.0), (2, 18.4, -66.4)], "area_id long, latitude double, longitude double")
    for events in (quakes, only_low, only_low + [(18.0, -66.0, 0.0, 1.0, as_of - dt.timedelta(hours=30))]):
        q = spark.createDataFrame(events, "latitude double, longitude double, magnitude double, depth_km double, time_utc timestamp")
        at = F.lit(as_of)
        got = rp.quake_by_step(areas, q.withColumn("step", rp.step_of(F.col("time_utc"), at, 24)), at, F.lit(-13), 24)
        got = {(x.area_id, x.step): x.earthquake_raw for x in got.collect()}
        for a, la, lo in ((1, 18.1, -66.0), (2, 18.4, -66.4)):
            for step in range(-13, 1):
                t, best = as_of + dt.timedelta(hours=24 * step), None
                for qla, qlo, m, d, when in events:
                    if when <= t:
                        p1, p2 = math.radians(la), math.radians(qla)
                        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(qlo - lo) / 2) ** 2
                        dist = 2 * 6371.0 * math.asin(math.sqrt(h))
                        x = (m or 0.0) / (1 + (d or 0.0) / 70) / math.log1p(max(dist, 1e-3)) * math.exp(-(t - when).total_seconds() / 3600 / 168)
                        best = x if best is None else max(best, x)
                v = got[a, step]
                assert (v is None) == (best is None) and (v is None or math.isclose(v, best, rel_tol=1e-9, abs_tol=1e-12)), (a, step)


@pytest.fixture(scope="module")
def replayed(spark):
    return R.indices_by_step(spark, SF).toPandas()


@pytest.mark.parametrize("back", [0, 3, 17])
def test_a_step_equals_the_batch_pipeline_at_that_time(spark, tmp_path, replayed, back):
    """Readings and alerts cut at the step's times; an event without weight marks the run time."""
    events, orders = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("events", "orders"))
    t = events.agg(F.max("ts")).first()[0] - dt.timedelta(days=back)
    a = orders.agg(F.max("o_orderdate")).first()[0] - dt.timedelta(days=back)
    mark = spark.createDataFrame([(23 * 10 ** 6, t, 9, "x", 0.0, "{\"k\": 1}")], events.schema)  # station 9 has no datum, the magnitude is missing
    events.filter(F.col("ts") <= F.lit(t)).unionByName(mark).write.parquet(f"{tmp_path}/events.parquet")
    # an alert in no band of its own marks the alerts' run time
    late = orders.limit(1).withColumns({"o_orderkey": F.lit(99).cast("long"), "o_orderdate": F.lit(a).cast("timestamp_ntz"), "o_orderpriority": F.lit("5-LOW")})
    cut = orders.filter(F.col("o_orderdate") <= F.lit(a))
    (cut if cut.filter(F.col("o_orderdate") == F.lit(a)).count() else cut.unionByName(late)).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("nation", "customer", "supplier", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    batch = {x.area_id: x for x in A.scored_indices(spark, str(tmp_path)).collect()}
    rows = replayed[replayed.step_utc == t]
    assert len(rows) == len(batch) > 0
    for x in rows.itertuples():
        b = batch[x.area_id]
        for c in ("nws_global_alert_score", "flood_hazard_muni", "earthquake_hazard_score", "hazard_combined", "risk_index_raw", "response_readiness_index",
                  "recovery_capacity_index", "priority_index", "confidence_score", "priority_index_conf_adj"):
            if c == "nws_global_alert_score" and not cut.filter(F.col("o_orderdate") == F.lit(a)).count():
                continue
            assert math.isclose(getattr(x, c), b[c], rel_tol=1e-9, abs_tol=1e-9), c
        assert x.priority_band == b.priority_band


def test_zone_timeline_covers_every_zone_and_step(spark):
    as_of = bind.read_table(spark, SF, "orders").select(F.max("o_orderdate")).scalar()
    one = R.zone_alert_timeline(bind.alerts(spark, SF), bind.alert_zones(spark, SF), as_of)
    rows = one.groupBy("zone_id").count().collect()
    assert len(rows) == bind.alert_zones(spark, SF).select("zone_id").distinct().count() and len({r["count"] for r in rows}) == 1
    at_end = {r.zone_id: r.zone_alert_score for r in one.filter(F.col("step_utc") == as_of).collect() if r.zone_alert_score}
    from tidewatch.operators.alerts import area_alert_score
    assert at_end == {r.zone_id: r.zone_alert_score for r in area_alert_score(bind.alerts(spark, SF), bind.alert_zones(spark, SF), as_of).collect()}
