"""Plan checks: no Python UDFs, partial top-k before the shuffle, pushdown."""
from tidewatch.plans import areas as A
from tidewatch.plans import stations as S

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_station_features_use_partial_window_limit(spark):
    p = _plan(S.station_latest_features(spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_series_scan_prunes_columns(spark):
    p = _plan(S.station_summary(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p \
        or "props" not in p.split("ReadSchema")[1].split("\n")[0]


def test_scored_has_no_python(spark):
    p = _plan(A.scored_indices(spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_no_registered_query_runs_python(spark):
    import __spark_entry__ as E
    from tidewatch.plans.registry import QUERIES
    bad = {}
    for name, fn in E.queries().items():
        if name not in QUERIES:  # optional parts choose their own style
            continue
        p = _plan(fn(spark, SF))
        hits = [k for k in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                            "MapInPandas", "PythonMapInArrow") if k in p]
        hits += [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin Inner", "BroadcastNestedLoopJoin Cross") if k in p]
        if hits:
            bad[name] = hits
    assert not bad


def test_quake_kernel_aggregates_events_before_the_area_loop(spark):
    from pyspark.sql import functions as F

    from tidewatch.operators.spatial import area_quake_raw
    from tidewatch.sources import bind
    areas = spark.createDataFrame([(1, 18.0, -66.0), (2, 18.3, -66.5)], "area_id long, latitude double, longitude double")
    df = area_quake_raw(areas, bind.earthquakes(spark, SF), F.lit("2024-01-01").cast("timestamp"))
    p = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = p.index("Join Inner")
    assert "Aggregate [lat" in p[join_at:]   # the (location, max factor) aggregate sits below the join


def test_per_row_lag_has_no_window_over_a_station(spark):
    """Skew guard: gaps / rates must not window by station (a hot station
    would land in one task); their windows run over sort partitions only."""
    import __spark_entry__ as E
    for name in ("station_gaps", "station_rates"):
        p = _plan(E.queries()[name](spark, SF))
        assert "windowspecdefinition(station_id" not in p, name
        assert "windowspecdefinition(_pid" in p, name
