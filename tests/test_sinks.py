"""Sinks: table round trips, GeoJSON features, publish projection and full refresh."""
import json

from pyspark.sql import functions as F

from tidewatch.sinks import writers as W


def _df(spark):
    return spark.createDataFrame(
        [(1, "a", 18.1, -66.1, "2024-01-02 03:04:05", None),
         (2, "b", None, -66.2, "2024-01-02 03:04:05", 7.5),
         (3, None, 18.3, -66.3, None, 1.0)],
        "id long, name string, latitude double, longitude double, t string, score double",
    ).withColumn("t", F.to_timestamp("t"))


def test_write_table_csv_and_parquet_round_trip(spark, tmp_path):
    df = _df(spark).drop("t")
    W.write_table(df, str(tmp_path / "p"))
    W.write_table(df, str(tmp_path / "c"), fmt="csv")
    back_p = spark.read.parquet(str(tmp_path / "p"))
    back_c = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "c"))
    assert sorted(back_p.collect()) == sorted(df.collect())
    assert sorted(back_c.collect()) == sorted(df.collect())


def test_geojson_features_drop_rows_without_coordinates(spark):
    feats = [json.loads(r.feature) for r in W.geojson_features(_df(spark)).collect()]
    by_id = {f["properties"]["id"]: f for f in feats}
    assert set(by_id) == {1, 3}
    f1 = by_id[1]
    assert f1["type"] == "Feature" and f1["geometry"] == {"type": "Point", "coordinates": [-66.1, 18.1]}
    assert f1["properties"]["t"] == "2024-01-02T03:04:05Z"
    assert "score" in f1["properties"] and f1["properties"]["score"] is None     # missing -> null
    dropped = {json.loads(r.feature)["properties"]["id"]: json.loads(r.feature)
               for r in W.geojson_features(_df(spark), keep_nulls=False).collect()}
    assert "score" not in dropped[1]["properties"] and "name" not in dropped[3]["properties"]


def test_publish_projection(spark):
    df = spark.createDataFrame([("x", "12.5", "2024-03-04 05:06:07")], "n string, v string, d string") \
        .withColumn("d", F.to_timestamp("d"))
    out = W.publish_projection(df, rename={"n": "name"}, numeric=["v"], dates={"d": "yyyy-MM-dd"})
    r = out.collect()[0]
    assert out.columns == ["name", "v", "d"] and r.v == 12.5 and r.d == "2024-03-04"
    bad = W.publish_projection(spark.createDataFrame([("n/a",)], "v string"), numeric=["v"]).collect()[0]
    assert bad.v is None


def test_publish_full_refresh_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "pub")
    assert W.publish_full_refresh(spark.range(10), path) == 10
    assert W.publish_full_refresh(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_geojson_has_no_nan(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, 18.0, -66.0, nan), (2, 18.0, -66.0, inf), (3, nan, -66.0, 1.0), (4, 18.0, -66.0, 2.5)],
                               "id long, latitude double, longitude double, score double")
    got = {f["properties"]["id"]: f["properties"]["score"] for f in (json.loads(r.feature) for r in W.geojson_features(df).collect())}
    assert got == {1: None, 2: None, 4: 2.5}


def test_publish_keeps_the_old_table_when_the_load_fails(spark, tmp_path):
    import os

    import pytest
    path = str(tmp_path / "pub")
    W.publish_full_refresh(spark.range(7), path)
    with pytest.raises(Exception):
        W.publish_full_refresh(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 7
    assert W.publish_full_refresh(spark.range(2), path) == 2
    assert not [f for f in os.listdir(tmp_path) if ".old-" in f]
