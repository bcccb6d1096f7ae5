"""Hand cases for the column builders (null, zero, degenerate, boundary)."""
import math

from pyspark.sql import functions as F

from tidewatch.functions import geo, numeric, text
from tidewatch.operators.alerts import alert_score_expr
from tidewatch.operators.scoring import band
from tidewatch.operators.timeseries import minor_threshold


def one(spark, expr, schema="x double", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr.alias("o")).collect()]


def test_clip_keeps_null(spark):
    out = one(spark, numeric.clip("x", 0.0, 100.0), rows=[(None,), (-5.0,), (50.0,), (150.0,)])
    assert out == [None, 0.0, 50.0, 100.0]


def test_normalize_linear_degenerate_and_bounds(spark):
    df = spark.createDataFrame([(0.5,), (None,), (2.0,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(numeric.normalize_linear("x", 0.0, 1.0)).collect()] == [50.0, None, 100.0, 0.0]
    assert [r[0] for r in df.select(numeric.normalize_linear("x", 1.0, 1.0)).collect()] == [None] * 4


def test_nan_mean(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 4.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(numeric.nan_mean("a", "b")).collect()] == [2.0, 4.0, None]


def test_band_boundaries(spark):
    rows = [(49.999,), (50.0,), (69.99,), (70.0,), (84.99,), (85.0,), (None,)]
    assert one(spark, band(F.col("x")), rows=rows) == ["Green", "Yellow", "Yellow", "Orange", "Orange", "Red", "Green"]


def test_alert_score(spark):
    rows = [("Flash Flood Warning", None), ("Flood Warning", "Minor"), ("Flood Watch", None),
            ("Wind Advisory", "Extreme"), ("Heat Advisory", "SEVERE"), (None, None), ("Test", "weird")]
    out = one(spark, alert_score_expr(F.col("e"), F.col("s")), "e string, s string", rows)
    assert out == [100, 70, 40, 100, 80, 25, 25]


def test_normalize_text(spark):
    rows = [("  Añasco ",), ("San Juan--Bayamón",), (None,), ("NATION_0",)]
    assert one(spark, text.normalize_text("x"), "x string", rows) == ["anasco", "san juan bayamon", "", "nation 0"]


def test_zip_codes_and_flags(spark):
    rows = [("00601, 00602; 00601 123456 x00603",)]
    assert one(spark, text.extract_zip_codes("x"), "x string", rows) == [["00601", "00602"]]
    assert one(spark, text.first_flag("x"), "x string", [("1,0,0",), ("a,b",), (None,)]) == [1, 0, 0]
    assert one(spark, text.zero_pad_code("x"), "x string", [("60",), (None,), ("1234567",)]) == \
        ["00060", "00000", "1234567"]


def test_haversine(spark):
    d = one(spark, geo.haversine_km(F.lit(18.0), F.lit(-66.0), F.lit(19.0), F.lit(-66.0)))[0]
    assert math.isclose(d, 6371.0 * math.radians(1.0), rel_tol=1e-12)


def test_minor_threshold_zero_falls_through(spark):
    df = spark.createDataFrame([(0.0, 1.5), (2.0, 1.5), (None, None)], "m double, a double")
    assert [r[0] for r in df.select(minor_threshold("m", "a")).collect()] == [1.5, 2.0, None]


def test_valid_coordinate(spark):
    df = spark.createDataFrame([(0.0, 0.0), (18.0, -66.0), (None, 1.0), (95.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(geo.valid_coordinate("a", "b")).collect()] == [False, True, False, False]


def test_ring_centroid(spark):
    df = spark.createDataFrame([([[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]],)],
                               "r array<array<array<double>>>")
    c = df.select(geo.ring_centroid("r").alias("c")).first()["c"]
    assert (c["lon"], c["lat"]) == (1.0, 0.5)


def test_bounds_predicate_optional_bounds(spark):
    from tidewatch.functions.numeric import bounds_predicate
    df = spark.createDataFrame([(1, 3.0, -66.0), (2, 2.0, -66.0), (3, None, -66.0), (4, 3.0, -65.0)],
                               "k long, m double, lon double")
    keep = lambda b: sorted(r.k for r in df.filter(bounds_predicate(b)).collect())
    assert keep({}) == [1, 2, 3, 4]
    assert keep({"m": (2.5, None)}) == [1, 4]
    assert keep({"m": (None, 2.5)}) == [2]
    assert keep({"m": (2.5, None), "lon": (None, -65.5)}) == [1]
    assert keep({"m": (None, None)}) == [1, 2, 3, 4]
    assert df.filter(~bounds_predicate({"m": (2.5, None)})).count() == 2   # the missing value is excluded, not null


def test_library_helpers_without_queries(spark, tmp_path):
    import datetime as dt

    from tidewatch.functions.geo import depth_factor_spec
    from tidewatch.functions.text import simple_key, split_list
    from tidewatch.functions.timefn import ts_to_epoch_ms
    from tidewatch.sources.envelopes import read_table_csv
    df = spark.createDataFrame([("  San Juan Bay ", " 8720030, ,9755371 ,", 10.0),
                                (None, None, 50.0), ("X", "", None), ("Y", "a", 90.0)],
                               "name string, ids string, depth double")
    r = df.select(simple_key("name").alias("k"), split_list("ids").alias("l"),
                  depth_factor_spec("depth").alias("f")).collect()
    assert r[0].k == "san_juan_bay" and r[1].k is None
    assert r[0].l == ["8720030", "9755371"] and r[1].l == [] and r[2].l == []
    assert [x.f for x in r] == [1.0, 0.7, 1.0, 0.4]          # <= 30, <= 70, missing -> 1.0, else 0.4
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 500000),)], "t timestamp_ntz")
    assert t.select(ts_to_epoch_ms("t").alias("ms")).first().ms == 1704067201500
    p = tmp_path / "lk.csv"
    p.write_text("code,name\n00060,Discharge\n00065,Gage height\n")
    lk = read_table_csv(spark, str(p), "code string, name string")
    assert sorted((x.code, x.name) for x in lk.collect()) == [("00060", "Discharge"), ("00065", "Gage height")]
