"""SP-14, SP-16, SP-17 and the bounded kernel mean against brute force."""
import datetime as dt
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import quality as Q
from tidewatch.operators import spatial
from tidewatch.operators.timeseries import gaps, out_of_order

START = dt.datetime(2024, 1, 1)


def series(spark, rows):
    return spark.createDataFrame(rows, "station_id long, obs_id long, time_utc timestamp, water_level double")


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_out_of_order_equals_brute_force(spark, parts):
    """A hot station over many sort partitions, borders between stations inside and at partitions, ties, missing times."""
    r = random.Random(parts)
    rows = []
    for k in range(2_000):
        s = 1 if k % 3 else r.randint(2, 40)
        rows.append((s, k, None if k % 97 == 0 else START + dt.timedelta(minutes=k - r.choice([0, 0, 0, 0, 30, 500])), 1.0))
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(x.station_id, x.obs_id): x.latest_before for x in out_of_order(series(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    want, top = {}, {}
    for s, k, t, _ in rows:
        if t is not None:
            if s in top and top[s] > t:
                want[s, k] = top[s]
            top[s] = max(top.get(s, t), t)
    assert got == want and len(want) > 100


def test_gap_kinds_with_an_arrival_column(spark):
    rows = [(1, 1, START, 1.0), (1, 2, START + dt.timedelta(hours=1), 1.0), (1, 3, START + dt.timedelta(hours=1), 1.0), (1, 4, START + dt.timedelta(hours=9), 1.0)]
    s = series(spark, rows)
    kinds = lambda d: sorted((x.obs_id, x.kind, x.gap_seconds) for x in d.collect())
    assert kinds(gaps(s, 60.0)) == [(3, "duplicate", 0.0), (4, "gap", 28_800.0)]
    late = s.withColumn("arrival", F.when(F.col("obs_id") == 1, F.lit(10)).otherwise(F.col("obs_id")))
    assert kinds(gaps(late, 60.0, arrival_col="arrival")) == [(1, "out_of_order", -32_400.0), (3, "duplicate", 0.0), (4, "gap", 28_800.0)]
    assert gaps(s.filter("false"), 60.0).count() == 0


def test_neighbour_means_leave_the_station_out(spark):
    """A lone station, one without a value, three at one place, and one at just the radius's other side."""
    rows = [(1, 18.0, -66.0, 10.0), (2, 18.0, -66.0, 20.0), (3, 18.0, -66.0, 60.0), (4, 18.05, -66.0, 5.0), (5, 18.05, -66.0, None), (6, 40.0, 10.0, 7.0), (7, None, -66.0, 9.0)]
    df = spark.createDataFrame(rows, "station_id long, lat double, lon double, _level double")
    got = {r.station_id: (round(r.neighbour_mean, 9), r.neighbours) for r in Q.neighbour_means(df, 12.0).collect()}
    assert got == {1: (round(85 / 3, 9), 3), 2: (25.0, 3), 3: (round(35 / 3, 9), 3), 4: (30.0, 3)}


def test_quality_of_a_lone_station_and_the_alert_state(spark):
    rows = [(1, 1, START, 5.0), (2, 2, START, 5.0), (3, 3, START, None)]
    s = series(spark, rows).withColumn("flags", F.lit("0,0"))
    meta = spark.createDataFrame([(1, 18.0, -66.0, 4.0), (2, 30.0, 10.0, None), (3, 50.0, 50.0, 1.0)], "station_id long, lat double, lon double, minor double")
    for active, want in ((True, (1.0, 1.0, 1.0)), (False, (0.0, 1.0, 1.0)), (None, (1.0, 1.0, 1.0))):
        d = Q.observation_quality(s, F.lit(START), lambda x: x.join(meta, "station_id"), None if active is None else F.lit(active))
        assert tuple(r.crosscheck_factor for r in d.orderBy("station_id").collect()) == want
        assert all(r.neighbour_agreement is None for r in d.collect())


@pytest.mark.parametrize("days", [1, 3, 7, 365])
def test_rolling_baseline_equals_brute_force(spark, days):
    """Windows that begin inside a block, at its border, and over days without readings."""
    r = random.Random(days)
    rows = [(s, k, START + dt.timedelta(days=d, hours=r.randint(0, 23)), None if r.random() < 0.1 else r.randint(0, 300) / 10)
            for k, (s, d) in enumerate((s, d) for s in (1, 2) for d in range(40) if (d * s) % 5 != 3 for _ in range(25 if s == 1 else 2))]
    by = defaultdict(list)
    for s, _, t, v in rows:
        if v is not None:
            by[s, (t - dt.datetime(1970, 1, 1)).days].append(v)
    df = series(spark, rows).repartition(4)
    sketch = {(x.station_id, x.day): x for x in Q.rolling_baseline(df, days).collect()}
    exact = {(x.station_id, x.day): x for x in Q.rolling_baseline_exact(df, days).collect()}
    assert sketch.keys() == exact.keys() == by.keys()
    for (s, d), e in exact.items():
        v = np.array(sorted(x for (t, u), vs in by.items() if t == s and d - days < u <= d for x in vs))
        assert e.n_values == sketch[s, d].n_values == len(v)
        assert math.isclose(e.baseline_p05, np.quantile(v, 0.05)) and math.isclose(e.baseline_p95, np.quantile(v, 0.95))
        for q, x in ((0.05, sketch[s, d].baseline_p05), (0.95, sketch[s, d].baseline_p95)):
            assert np.searchsorted(v, x, "left") <= math.ceil(len(v) * (q + Q.SKETCH_RANK_ERROR))
            assert np.searchsorted(v, x, "right") >= math.floor(len(v) * (q - Q.SKETCH_RANK_ERROR))


def test_sketch_ranks_on_many_readings_of_one_station(spark):
    df = spark.range(60_000).select(F.lit(1).cast("long").alias("station_id"), F.col("id").alias("obs_id"),
                                    F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 20).alias("time_utc"),
                                    (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000.0).alias("water_level"))
    got = Q.rolling_baseline(df, 10).collect()
    assert len(got) == 14
    for x in got:
        assert abs(x.baseline_p05 / 1000.003 - 0.05) < 0.02 and abs(x.baseline_p95 / 1000.003 - 0.95) < 0.02
    checked = Q.rolling_baseline_checked(df, 10)
    assert checked.filter("p05_in_bound AND p95_in_bound").count() == 14


@pytest.mark.parametrize("cell_km", [0.5, 5.0])
def test_bounded_mean_holds_its_bounds_with_fewer_pairs(spark, cell_km):
    r = random.Random(4)
    areas = [(k, 18 + r.random() / 2, -66 - r.random()) for k in range(12)] + [(50, None, -66.0), (51, 18.2, 179.9)]
    places = [(17.9 + r.random() / 20, -66.0 - r.random() / 20) for _ in range(300)] + [(18 + r.random() / 2, -66 - r.random()) for _ in range(60)] + [(18.2, -179.95), (89.99, 5.0)]
    st = [(la, lo, r.uniform(0, 100)) for la, lo in places for _ in range(r.choice([1, 1, 3]))] + [(None, -66.0, 50.0)]
    a = spark.createDataFrame(areas, "area_id long, latitude double, longitude double")
    s = spark.createDataFrame(st, "lat double, lon double, flood_hazard_final double")
    exact = {x.area_id: x.flood_hazard_weighted for x in spatial.area_flood_hazard(a, s, F.lit(0.0)).collect()}
    got = {x.area_id: x for x in spatial.bounded_flood_mean(a, s, cell_km=cell_km).collect()}
    assert got.keys() == exact.keys()
    for k, x in got.items():
        assert x.mean_lo - 1e-9 <= exact[k] <= x.mean_hi + 1e-9
        assert x.mean_lo - 1e-9 <= x.flood_hazard_weighted <= x.mean_hi + 1e-9
        assert x.mean_hi <= x.mean_lo * math.exp(4 * cell_km * 0.75 / 25) + 1e-9
    assert sum(x.pairs for x in got.values()) < (0.9 if cell_km == 0.5 else 0.6) * len(exact) * len(set(places))


def test_exact_rolling_baseline_handles_each_count_once(spark):
    """Ranges of any length, levels in three steps of the search, readings without a station or a level."""
    r = random.Random(9)
    rows = [(1, k, START + dt.timedelta(days=k % 30), r.randint(0, 900) / 7) for k in range(1_500)] + [(2, 9_000, START, -0.0), (None, 9_001, START, 1.0), (2, 9_002, START, None)]
    df = series(spark, rows)
    got = {(x.station_id, x.day): x for x in Q.rolling_baseline_exact(df, 40_000).collect()}
    first = (START - dt.datetime(1970, 1, 1)).days
    assert got.keys() == {(1, first + d) for d in range(30)} | {(2, first)}
    for d in range(30):
        v = [x for s, k, _, x in rows if s == 1 and k % 30 <= d]
        x = got[1, first + d]
        assert x.n_values == len(v) and math.isclose(x.baseline_p05, np.quantile(v, 0.05)) and math.isclose(x.baseline_p95, np.quantile(v, 0.95))
    assert got[2, first].baseline_p05 == got[2, first].baseline_p95 == 0.0 and got[2, first].n_values == 1
    assert "sequence(" not in Q.rolling_baseline_exact(df, 365)._jdf.queryExecution().optimizedPlan().toString()  # no reading is repeated for the days it counts in


def test_rolling_sketches_are_not_repeated_for_days_without_readings(spark):
    """A first day of the range in the block before, with gaps around it, and a station with one reading in a block's middle."""
    days = [400, 401, 640, 729, 731, 1_000, 1_094, 1_095, 1_500]
    rows = [(1, k, dt.datetime(1970, 1, 1) + dt.timedelta(days=d), float(d)) for k, d in enumerate(days)] + [(2, 50, dt.datetime(1970, 1, 1) + dt.timedelta(days=500), 3.0)]
    df = series(spark, rows)
    got = {(x.station_id, x.day): (x.n_values, x.baseline_p05) for x in Q.rolling_baseline(df).collect()}
    seen = {d: [x for x in days if d - 365 < x <= d] for d in days}
    assert got == {(1, d): (len(x), float(x[0])) for d, x in seen.items()} | {(2, 500): (1, 3.0)}
    checked = Q.rolling_baseline_checked(df)
    assert {(x.station_id, x.day): (x.n_values, x.p05_in_bound, x.p95_in_bound) for x in checked.collect()} == {k: (n, True, True) for k, (n, _) in got.items()}
    assert "sequence(" not in checked._jdf.queryExecution().optimizedPlan().toString()


def test_values_outside_the_rank_error_are_told(spark, monkeypatch):
    """A sketch that gives other values than its shares: below, above, and inside."""
    df = series(spark, [(1, k, START, float(k)) for k in range(1_000)])
    day = (START - dt.datetime(1970, 1, 1)).days
    for p05, p95, want in ((50.0, 949.0, (True, True)), (62.0, 962.0, (True, True)), (63.0, 963.0, (False, False)), (36.9, 936.9, (False, False)), (-1.0, 5_000.0, (False, False))):
        fake = spark.createDataFrame([(1, day, p05, p95, 1_000)], "station_id long, day long, baseline_p05 double, baseline_p95 double, n_values long")
        monkeypatch.setattr(Q, "rolling_baseline", lambda *a, _f=fake, **k: _f)
        (x,) = Q.rolling_baseline_checked(df).collect()
        exact = [(sum(k < v for k in range(1_000)) <= math.ceil(1_000 * (q + 0.012)) and sum(k <= v for k in range(1_000)) >= math.floor(1_000 * (q - 0.012)))
                 for v, q in ((p05, 0.05), (p95, 0.95))]
        assert (x.p05_in_bound, x.p95_in_bound) == tuple(exact) == want
