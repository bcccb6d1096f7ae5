"""Operator-level cases and properties (brute force where the operator is a strategy)."""
import math
import random

from pyspark.sql import functions as F

from tidewatch.operators import scoring as sc
from tidewatch.operators import spatial
from tidewatch.operators.timeseries import latest_and_previous, with_station_hazard


def test_single_reading_previous_is_itself(spark):
    s = spark.createDataFrame([(1, 1, "2024-01-01 00:00:00", 2.0),
                               (2, 2, "2024-01-01 00:00:00", 1.0), (2, 3, "2024-01-01 01:00:00", 1.3)],
                              "station_id long, obs_id long, t string, water_level double")
    s = s.withColumn("time_utc", F.to_timestamp("t"))
    lp = latest_and_previous(s).withColumn("minor", F.lit(1.0)).withColumn("major", F.lit(3.0))
    rows = {r.station_id: r for r in with_station_hazard(lp).collect()}
    assert rows[1].rise_rate_per_hour == 0.0
    assert math.isclose(rows[2].rise_rate_per_hour, 0.3)
    assert rows[2].rise_score == 100.0


def test_robust_score_degenerate_and_direction(spark):
    df = spark.createDataFrame([(float(i), 5.0, None) for i in range(101)], "x double, c double, n double")
    out = sc.robust_scores(df, [("x", "sx", True), ("c", "sc", True), ("n", "sn", True), ("x", "inv", False)])
    rows = out.orderBy("x").collect()
    assert rows[0].sx == 0.0 and rows[-1].sx == 100.0 and rows[0].inv == 100.0
    assert all(r.sc is None and r.sn is None for r in rows)
    vals = [r.sx for r in rows]
    assert vals == sorted(vals)


def test_minmax_score_monotone_and_invert(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (5.0,)], "x double")
    out = sc.minmax_scores(df, [("x", "s", False), ("x", "i", True)]).orderBy(F.col("x").asc_nulls_first()).collect()
    assert [r.s for r in out] == [None, 0.0, 0.5, 1.0]
    assert [r.i for r in out] == [None, 1.0, 0.5, 0.0]


def _points(spark, n, seed):
    rnd = random.Random(seed)
    return [(i, 17.9 + rnd.random() * 0.6, -67.3 + rnd.random() * 2.1) for i in range(n)]


def test_radius_join_equals_brute_force(spark):
    from tidewatch.functions.geo import haversine_km
    a = spark.createDataFrame(_points(spark, 300, 1), "aid long, latitude double, longitude double")
    b = spark.createDataFrame(_points(spark, 200, 2), "bid long, lat double, lon double")
    grid = {(r.aid, r.bid) for r in spatial.radius_join(a, b, 12.0).select("aid", "bid").collect()}
    brute = a.crossJoin(b).withColumn("d", haversine_km("latitude", "longitude", "lat", "lon"))
    exact = {(r.aid, r.bid) for r in brute.filter("d <= 12.0").select("aid", "bid").collect()}
    assert grid == exact and len(exact) > 0


def _globe(n, seed):
    """Points everywhere: both sides of the antimeridian, poles, latitude 60, and half of them in one dense place."""
    r = random.Random(seed)
    out = [(-179.99 + 0.005 * k, 10.0) for k in range(4)] + [(179.97 + 0.01 * k, 10.01) for k in range(3)] + [(180.0, 10.02), (-180.0, 10.03)]
    out += [(r.uniform(-180, 180), s * (89.9 + r.random() / 10)) for s in (1, -1) for _ in range(n // 10)] + [(0.0, 90.0), (5.0, -90.0)]
    out += [(20 + r.random() / 2, 60 + r.random() / 2) for _ in range(n // 5)] + [(r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(n // 5)]
    out += [(-66 + r.random() / 100, 18 + r.random() / 100) for _ in range(n - len(out))] + [(None, 18.0), (-66.0, None)]
    return [(k, lat, lon) for k, (lon, lat) in enumerate(out)]


def _km(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def test_radius_join_all_over_the_globe(spark):
    left, right = _globe(160, 11), _globe(120, 12)
    a = spark.createDataFrame(left, "aid long, latitude double, longitude double")
    b = spark.createDataFrame(right, "bid long, lat double, lon double")
    for r in (0.5, 12.0, 300.0, 9_000.0, 21_000.0):
        got = {(x.aid, x.bid) for x in spatial.radius_join(a, b, r).select("aid", "bid").collect()}
        near = {(x[0], y[0]): _km(x, y) for x in left for y in right if None not in (*x, *y)}
        assert {k for k, d in near.items() if d <= r * (1 - 1e-9)} <= got <= {k for k, d in near.items() if d <= r * (1 + 1e-9)}


def test_a_dense_cell_is_dealt_to_several_keys(spark):
    a = spark.range(4_000).select(F.col("id").alias("aid"), F.lit(18.0).alias("latitude"), (F.lit(-66.0) + F.col("id") / 1e6).alias("longitude"))
    b = spark.createDataFrame([(1, 18.0, -66.0)], "bid long, lat double, lon double")
    pairs = spatial.radius_join(a, b, 12.0)
    assert pairs.count() == 4_000
    assert "_cs" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_join_equals_brute_force_far_and_across_the_antimeridian(spark):
    left = _globe(60, 13)
    for right in (_globe(40, 14), [(7, 18.0, -66.0), (3, 18.0, -66.0)], [(1, -45.0, 179.9)], [(1, None, 0.0)], []):
        a = spark.createDataFrame(left, "town long, latitude double, longitude double")
        b = spark.createDataFrame(right, "area_id long, lat double, lon double")
        got = {x.town: (x.area_id, x.dist_km) for x in spatial.nearest_join(a, b, "town", "area_id").collect()}
        assert len(got) == len(left)
        known = [y for y in right if None not in y]
        for x in left:
            if None in x or not known:
                assert got[x[0]] == (None, None)
                continue
            best = min(_km(x, y) for y in known)
            area, d = got[x[0]]
            assert math.isclose(d, best, rel_tol=1e-6, abs_tol=1e-6) and area in {y[0] for y in known if _km(x, y) <= best + 1e-6}
            if len(known) == 2:
                assert area == 3  # of two at one place the smaller key


def test_kernel_aggregate_equals_brute_force_with_any_buckets(spark):
    areas, points = _points(spark, 40, 3), _points(spark, 60, 4)
    a = spark.createDataFrame(areas, "area_id long, latitude double, longitude double")
    p = spark.createDataFrame([(x[1], x[2], float(x[0] % 7)) for x in points], "lat double, lon double, h double")

    def aggs(d):
        return [F.sum(F.exp(-d / 25.0) * F.col("h")).alias("s"), F.max(F.when(d <= 12.0, F.col("h"))).alias("m"), F.count("*").alias("n")]

    def km(la, lo, pa, po):
        la, lo, pa, po = map(math.radians, (la, lo, pa, po))
        x = math.sin((pa - la) / 2) ** 2 + math.cos(la) * math.cos(pa) * math.sin((po - lo) / 2) ** 2
        return 2 * spatial.KM_PER_RAD * math.asin(math.sqrt(x))

    want = {}
    for i, la, lo in areas:
        d = [(km(la, lo, pa, po), float(k % 7)) for k, pa, po in points]
        want[i] = (round(sum(math.exp(-x / 25) * h for x, h in d), 6), max((h for x, h in d if x <= 12), default=None), len(points))
    for ab, pb in ((8, 16), (1, 1), (7, 3)):
        got = {r.area_id: (round(r.s, 6), r.m, r.n) for r in spatial.kernel_aggregate(a, p, "area_id", aggs, area_buckets=ab, point_buckets=pb).collect()}
        assert got == want


def test_area_flood_hazard_weighs_every_station_at_one_place(spark):
    areas = spark.createDataFrame([(1, 18.0, -66.0), (2, 18.4, -66.4), (3, None, -66.0)], "area_id long, latitude double, longitude double")
    st = [(18.01, -66.0, 40.0), (18.01, -66.0, 80.0), (18.01, -66.0, None), (18.4, -66.4, 10.0), (None, -66.0, 99.0)]
    df = spark.createDataFrame(st, "lat double, lon double, flood_hazard_final double")
    got = {r.area_id: r for r in spatial.area_flood_hazard(areas, df, F.lit(0.0)).collect()}
    assert set(got) == {1, 2}
    assert got[1].flood_hazard_local_max == 80.0 and got[2].flood_hazard_local_max == 10.0
    assert (got[1].supporting_station_count, got[1].nearby_station_count) == (5, 3)
    assert (got[2].supporting_station_count, got[2].nearby_station_count) == (5, 1)


def test_recommended_actions_default_and_order(spark):
    df = spark.createDataFrame([(85.0, 10.0, 10.0, 50.0, 50.0), (10.0, 10.0, 10.0, 50.0, 50.0),
                                (10.0, 75.0, 75.0, 30.0, 30.0)],
                               "flood_hazard_muni double, earthquake_hazard_score double, vulnerability_score double,"
                               " response_readiness_index double, recovery_capacity_index double")
    out = [r[0] for r in df.select(sc.recommended_actions(df)).collect()]
    assert out[0] == "Pre-position swift-water rescue assets | Issue targeted flood risk communications"
    assert out[1] == "Maintain monitoring and readiness checks"
    assert out[2].split(" | ")[0] == "Validate emergency inspection and shelter plans" and out[2].count("|") == 3


def test_baseline_percentiles_close_to_exact(spark):
    from tidewatch.operators.quality import baseline_percentiles
    from tidewatch.plans.stations import tidal_series
    from tidewatch.sources.bind import series_as_of
    sf = "/root/testdata/sf0.001"
    s = tidal_series(spark, sf)
    approx = {r.station_id: r for r in baseline_percentiles(s, series_as_of(spark, sf)).collect()}
    exact = {r.station_id: r for r in s.groupBy("station_id").agg(
        F.percentile("water_level", 0.05).alias("p05"), F.percentile("water_level", 0.95).alias("p95"),
        F.min("water_level").alias("lo"), F.max("water_level").alias("hi")).collect()}
    assert approx.keys() == exact.keys()
    for k, r in approx.items():
        e = exact[k]
        assert e.lo <= r.baseline_p05 <= r.baseline_p95 <= e.hi


def test_dedupe_first_matches_brute_force(spark):
    from tidewatch.operators.catalog import dedupe_first
    rng = random.Random(7)
    # one hot key holding a third of the rows
    rows = [(("hot" if i % 3 == 0 else f"k{rng.randrange(40)}"), rng.randrange(10_000) * 10 + i % 10, f"v{i}")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, seq long, v string")
    got = {r.id: (r.seq, r.v) for r in dedupe_first(df, "id", "seq").collect()}
    want = {}
    for k, s, v in rows:
        if k not in want or (s, v) < want[k]:
            want[k] = (s, v)
    assert got == want


def test_catalog_steps(spark):
    from tidewatch.operators.catalog import dedupe_first, in_catalog_box, on_tidal_datum, with_coordinate_fallback
    entries = spark.createDataFrame([
        ("a", 1, 30.0, -66.0), ("a", 2, 18.0, -66.0),   # first entry outside the box: the second stays
        ("b", 1, 18.1, -66.1), ("b", 2, 18.2, -66.2),   # both inside: the first stays
        ("c", 1, None, -66.0), ("d", 1, 0.0, 0.0),      # no position, wrong position: outside
    ], "id string, seq int, lat double, lon double")
    box = (17.8, 18.6, -67.5, -65.0)
    got = {r.id: (r.seq, r.lat) for r in dedupe_first(in_catalog_box(entries, box), "id", "seq").collect()}
    assert got == {"a": (2, 18.0), "b": (1, 18.1)}
    st = spark.createDataFrame([
        ("a", 18.0, -66.0, True),    # valid, kept as is
        ("b", 0.0, 0.0, True),       # (0, 0) -> fallback
        ("c", None, -66.0, True),    # missing -> no fallback row -> dropped
        ("d", 95.0, -66.0, None),    # out of range -> fallback, but datum flag missing -> dropped
        ("e", 18.0, -66.0, False),   # not tidal -> dropped
    ], "id string, lat double, lon double, tidal boolean")
    lk = spark.createDataFrame([("b", 18.2, -66.2), ("b", 18.2, -66.2), ("d", 18.1, -66.1)],
                               "id string, fb_lat double, fb_lon double")
    out = on_tidal_datum(with_coordinate_fallback(st, lk, "id"))
    assert {r.id: (r.lat, r.lon, r.coord_source) for r in out.collect()} == {"a": (18.0, -66.0, "feed"), "b": (18.2, -66.2, "fallback")}


def test_station_selection_and_sorted_ids(spark):
    from tidewatch.operators.catalog import sorted_ids, station_selection
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "station_id long")
    chosen = lambda *a: sorted((r.station_id, r.selection_mode) for r in station_selection(*a).collect())
    assert chosen(ids(1, 2, 3), ids(2, 9), ids()) == [(2, "requested")]
    assert chosen(ids(1, 2, 3), ids(2, 9), ids(2)) == []  # every requested station excluded
    assert chosen(ids(1, 2, 3), ids(9), ids(3)) == [(1, "catalog"), (2, "catalog")]
    assert [r.station_id for r in sorted_ids(ids(9, 10, 2, 100, 9)).collect()] == [10, 100, 2, 9]
    assert [r.station_id for r in sorted_ids(ids(9, 10, 2, 100), cap=2).collect()] == [10, 100]


def test_station_codes_keep_long_ids(spark):
    from tidewatch.sources.bind import station_meta_columns
    df = spark.createDataFrame([(7,), (12345,), (12346,)], "sid long")
    assert [r[0] for r in df.select(station_meta_columns(F.col("sid"))["shefcode"]).collect()] == ["PR0007", "PR12345", "PR12346"]


def test_assert_rows_guards(spark):
    import pytest
    from tidewatch.operators.catalog import assert_rows
    df = spark.range(5)
    assert assert_rows(df, 1, 10).count() == 5
    with pytest.raises(Exception, match="more than 3"):
        assert_rows(df, 1, 3, what="catalogue").count()
    with pytest.raises(Exception, match="at least 1"):
        assert_rows(df.filter("id < 0"), 1).count()


def test_area_quake_raw_matches_brute_force(spark):
    """Pre-aggregating co-located events must not change the per-area maximum
    (negative magnitudes, missing magnitude / depth / position included)."""
    import datetime as dt
    from tidewatch.operators.spatial import area_quake_raw
    rng = random.Random(3)
    as_of = dt.datetime(2024, 1, 10)
    locs = [(17.5 + rng.random(), -67.5 + 2 * rng.random()) for _ in range(15)]
    quakes = []
    for i in range(400):
        la, lo = locs[rng.randrange(len(locs))]
        if i % 37 == 0:
            la = None
        mag = None if i % 11 == 0 else rng.uniform(-1.0, 6.0)
        depth = None if i % 13 == 0 else rng.uniform(0, 150)
        quakes.append((la, lo, mag, depth, as_of - dt.timedelta(hours=rng.uniform(-5, 400))))
    areas = [(k, 17.6 + rng.random(), -67.4 + 2 * rng.random()) for k in range(12)] + [(99, None, -66.0)]
    qdf = spark.createDataFrame(quakes, "latitude double, longitude double, magnitude double, depth_km double,"
                                        " time_utc timestamp")
    adf = spark.createDataFrame(areas, "area_id long, latitude double, longitude double")
    got = {r.area_id: r.earthquake_raw for r in area_quake_raw(adf, qdf, F.lit(as_of).cast("timestamp")).collect()}

    def hav(a1, o1, a2, o2):
        p1, p2 = math.radians(a1), math.radians(a2)
        a = math.sin(math.radians(a2 - a1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(o2 - o1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(a))

    want = {}
    for k, ala, alo in areas:
        if ala is None:
            continue
        vals = []
        for la, lo, mag, depth, t in quakes:
            if la is None:
                continue
            age = (as_of - t).total_seconds() / 3600.0
            d = hav(ala, alo, la, lo)
            vals.append((mag or 0.0) / math.log1p(max(d, 1e-3)) / (1 + (depth or 0.0) / 70.0)
                        * math.exp(-max(age, 0.0) / 168.0))
        want[k] = max(vals)
    assert set(got) == set(want)
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12)


def test_with_prev_matches_brute_force_with_hot_station(spark):
    import datetime as dt
    from tidewatch.operators.timeseries import with_prev
    rng = random.Random(21)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(4000):
        sid = 7 if i % 3 == 0 else rng.randrange(30)          # a third of the rows on one station
        t = t0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 5))
        if i % 50 == 0 and rows:                               # duplicate timestamps
            t = rows[-1][2]
        rows.append((sid, i, t, None if i % 13 == 0 else rng.random()))
    df = spark.createDataFrame(rows, "station_id long, obs_id long, time_utc timestamp, water_level double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.obs_id: (r.prev_obs_id, r.prev_time_utc, r.prev_water_level) for r in with_prev(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    last = {}
    for sid, oid, t, v in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        p = last.get(sid)
        want[oid] = (p[1], p[2], p[3]) if p else (None, None, None)
        last[sid] = (sid, oid, t, v)
    assert got == want


def test_zone_reference_or_fallback(spark):
    from tidewatch.operators.alerts import zones_or_fallback
    schema = "zone_id string, zone_name string, zone_lat double, zone_lon double, zone_state string"
    one = spark.createDataFrame([("PRZ004", "North", 18.0, -66.0, "PR")], schema)
    assert [tuple(r) for r in zones_or_fallback(one).collect()] == [("PRZ004", "North", 18.0, -66.0, "PR")]
    made = [tuple(r) for r in zones_or_fallback(one.filter("false")).orderBy("zone_id").collect()]
    assert len(made) == 13 and made[0] == ("PRZ001", "Puerto Rico Zone 001", None, None, None) and made[-1][:2] == ("PRZ013", "Puerto Rico Zone 013")
