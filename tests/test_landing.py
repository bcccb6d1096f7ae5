"""Landed JSON feeds: by file equals by column, broken files are rejects, streams continue."""
import pytest
from pyspark.sql import functions as F

from tidewatch.plans import queries_extra, queries_feeds, queries_io
from tidewatch.sources import envelopes as env
from tidewatch.sources import landing

SF = "/root/testdata/sf0.001"
DOCS = {"catalog": queries_feeds._catalog_docs, "station_meta": queries_extra._meta_docs, "observations": queries_io._obs_docs, "alerts": queries_io._alert_docs,
        "zones": queries_io._zone_docs, "forecast": queries_feeds._forecast_docs, "quakes": queries_io._quake_docs, "water": queries_io._water_docs}


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("feed", sorted(DOCS))
def test_files_give_the_rows_of_the_column(spark, tmp_path, feed):
    """Some documents of every feed, one a file with line breaks, and three that do not parse."""
    docs = spark.createDataFrame(DOCS[feed](spark, SF).select("payload").take(23))
    pages = docs.select(F.monotonically_increasing_id().cast("string").alias("page"), F.regexp_replace("payload", ",\"", ",\n  \"").alias("payload"))
    broken = spark.createDataFrame([("b1", "{\"features\": ["), ("b2", "<html>gone</html>"), ("b3", "{\"stations\": [}]")], "page string, payload string")
    landing.land(pages.unionByName(broken), f"{tmp_path}/in")
    schema, flatten = landing.FEEDS[feed]
    want = rows(flatten(env._parse(docs, "payload", schema)))
    got, rejects = landing.read_feed(spark, feed, f"{tmp_path}/in/page=*")
    assert rows(got) == want and want
    assert sorted(r.file.split("page=")[1][:2] for r in rejects.collect()) == ["b1", "b2", "b3"]
    assert "<html>gone</html>" in {r.payload.strip() for r in rejects.collect()}
    got, rejects = landing.stream_feed(spark, feed, f"{tmp_path}/in/page=*", f"{tmp_path}/state", max_files=10)
    assert rows(got) == want and rejects.count() == 3


def test_a_stream_continues_with_files_that_come_later(spark, tmp_path):
    docs = queries_io._quake_docs(spark, SF).select("payload").take(6)
    for k in range(2):
        part = spark.createDataFrame([(f"{k}-{n}", r.payload) for n, r in enumerate(docs[3 * k:3 * k + 3])], "page string, payload string")
        part.write.mode("append").partitionBy("page").text(f"{tmp_path}/in")
        got, rejects = landing.stream_feed(spark, "quakes", f"{tmp_path}/in/page=*", f"{tmp_path}/state")
        assert got.count() == 3 * (k + 1) and rejects.count() == 0
        assert landing.stream_feed(spark, "quakes", f"{tmp_path}/in/page=*", f"{tmp_path}/state")[0].count() == 3 * (k + 1)


def test_header_tables_by_file(spark, tmp_path):
    pages = spark.createDataFrame([("1", '[["NAME","X"],\n ["a","1"],\n ["b",null]]'), ("2", '[["X","NAME"],["2","c"]]'), ("3", "[[\"NAME\""), ("4", "[]")], "page string, payload string")
    landing.land(pages, f"{tmp_path}/in")
    got, rejects = landing.read_header_tables(spark, f"{tmp_path}/in/page=*", ["NAME", "X"])
    assert rows(got) == ["('a', '1')", "('b', None)", "('c', '2')"]
    assert rejects.count() == 2


def test_many_files_are_listed_by_few_tasks(spark, tmp_path):
    sc = spark.sparkContext
    most = landing.LISTING_TASKS * sc.defaultParallelism
    pages = spark.range(most + 40).select(F.col("id").alias("page"), F.format_string('{"features": [{"id": "pr%d"}]}', "id").alias("payload"))
    landing.land(pages, f"{tmp_path}/in")
    before = spark.conf.get(landing.LISTING_CONF)
    sc.setJobGroup("listing", "listing")
    try:
        got, rejects = landing.read_feed(spark, "quakes", f"{tmp_path}/in/page=*")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert len(stages) > 1 and max(s.numTasks for s in stages) <= most
    by_stream, _ = landing.stream_feed(spark, "quakes", f"{tmp_path}/in/page=*", f"{tmp_path}/state")
    assert spark.conf.get(landing.LISTING_CONF) == before
    assert got.count() == by_stream.count() == most + 40 and rejects.count() == 0
