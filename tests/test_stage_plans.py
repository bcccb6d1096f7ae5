"""Executed plans of every job a query runs, the eager stage writes included."""
import re

import pytest

from tidewatch.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# windows over one row per sort partition, per zone of the reference or per area (bounded tables)
BAD = re.compile(r"CartesianProduct|BatchEvalPython|ArrowEvalPython|MapInArrow|MapInPandas|FlatMapGroupsInPandas|PythonUDF|"
                 r"BroadcastNestedLoopJoin (?!LeftOuter|LeftSemi|LeftAnti|RightOuter|ExistenceJoin)")
STAGED = ["scored_indices", "priority_actions", "area_hazard", "earthquake_spec_intensity", "forced_bands", "fairness_by_quartile",
          "weight_sensitivity", "spearman_backtest", "station_gaps", "route_access", "spec_station_hazard", "station_outliers",
          "alerts_by_zone", "zone_phase", "published_towns", "indices_replay", "zone_alert_timeline"]


@pytest.fixture
def written(spark, monkeypatch):
    """Plans of all stage writes."""
    from tidewatch import session
    plans = []
    real = session.stage_checkpoint

    def noted(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    import tidewatch.operators.ranking as ranking
    import tidewatch.plans.areas as areas
    import tidewatch.plans.replay as replay
    for module in (session, ranking, areas, replay):
        monkeypatch.setattr(module, "stage_checkpoint", noted)
    return plans


@pytest.mark.parametrize("name", STAGED)
def test_no_stage_runs_python_or_a_nested_loop(spark, written, name):
    df = QUERIES[name](spark, SF)
    plans = [*written, ("result", df._jdf.queryExecution().executedPlan().toString())]
    for stage, plan in plans:
        assert not BAD.search(plan), (stage, BAD.search(plan)[0])


def test_scored_indices_write_few_stages_and_features_once(spark, written):
    QUERIES["fairness_by_quartile"](spark, SF)
    names = [n for n, _ in written]
    assert len(names) <= 7, names


def test_hot_station_is_spread_over_tasks(spark):
    """Half the rows on one station, no broadcast: no partition of the join holds them all."""
    from pyspark.sql import functions as F

    from tidewatch.operators.timeseries import outliers
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("station_id"),
                                      F.col("id").alias("obs_id"), F.timestamp_seconds("id").alias("time_utc"), (F.col("id") % 17).cast("double").alias("water_level"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = outliers(rows).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in out) == 40_000 and max(r["count"] for r in out) < 12_000
