"""Distributed ranks equal Spark's window functions (ties, nulls, several partitions)."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators import ranking as R


def _data(spark, n=3000, seed=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a hot value holding a third of the rows, some nulls, many small ties
        v = 5.0 if i % 3 == 0 else (None if i % 17 == 0 else float(rng.randrange(200)))
        rows.append((i, v, rng.choice(["a", "b", "c"])))
    return spark.createDataFrame(rows, "k long, v double, g string").repartition(7)


import pytest


@pytest.fixture(autouse=True)
def _many_partitions(spark):
    """Keep several range partitions (AQE would coalesce these small inputs to one)."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def _by_key(df, col):
    return {r.k: r[col] for r in df.select("k", col).collect()}


def test_row_number_rank_average_percent_ntile(spark):
    d = _data(spark)
    order = [F.col("v").desc_nulls_last(), F.col("k")]
    w = Window.orderBy(*order)
    ref = d.select("k", F.row_number().over(w).alias("rn"), F.ntile(4).over(w).alias("nt"),
                   F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last(), F.col("k"))).alias("pr"),
                   F.rank().over(Window.orderBy("v")).alias("rk"),
                   F.count(F.lit(1)).over(Window.partitionBy("v")).alias("ties"))
    ref = {r.k: r for r in ref.collect()}
    assert _by_key(R.global_row_number(d, order, "x"), "x") == {k: r.rn for k, r in ref.items()}
    assert _by_key(R.global_ntile(d, order, 4, "x"), "x") == {k: r.nt for k, r in ref.items()}
    pr = _by_key(R.global_percent_rank(d, [F.col("v").asc_nulls_last(), F.col("k")], ["v", "k"], "x"), "x")
    assert all(abs(pr[k] - r.pr) < 1e-12 for k, r in ref.items())
    rk = _by_key(R.global_rank(d, [F.col("v").asc_nulls_first()], ["v"], "x"), "x")
    assert rk == {k: r.rk for k, r in ref.items()}
    avg = _by_key(R.global_rank(d, [F.col("v").asc_nulls_first()], ["v"], "x", average=True), "x")
    assert all(avg[k] == r.rk + (r.ties - 1) / 2.0 for k, r in ref.items())


def test_numbering_spans_several_partitions(spark):
    d = _data(spark)
    s = d.orderBy(F.col("v"), F.col("k")).withColumn("_gid", F.monotonically_increasing_id())
    assert s.select(F.countDistinct(F.shiftright("_gid", 33))).first()[0] > 1


def test_row_number_within_groups(spark):
    d = _data(spark, 2000, seed=5)
    order = [F.col("v").desc(), F.col("k")]
    ref = _by_key(d.withColumn("x", F.row_number().over(Window.partitionBy("g").orderBy(*order))), "x")
    assert _by_key(R.row_number_within(d, ["g"], order, "x"), "x") == ref


def test_ntile_small_tables(spark):
    for n in (1, 2, 3, 5, 9):
        d = spark.range(n).withColumnRenamed("id", "k")
        ref = _by_key(d.withColumn("x", F.ntile(4).over(Window.orderBy("k"))), "x")
        assert _by_key(R.global_ntile(d, [F.col("k")], 4, "x"), "x") == ref


def test_grouped_discrete_quantile_matches_percentile(spark):
    rng = random.Random(9)
    rows = [(("hot" if i % 3 == 0 else f"g{rng.randrange(6)}"), None if i % 29 == 0 else rng.randrange(40))
            for i in range(3000)] + [("single", 7), ("nulls", None)]
    d = spark.createDataFrame(rows, "g string, v long")
    for q in (0.05, 0.5, 0.95):
        got = {r.g: r.x for r in R.grouped_discrete_quantile(d, ["g"], "v", q, "x").collect()}
        ref = {r.g: r.x for r in d.groupBy("g").agg(F.percentile("v", q).alias("x")).collect() if r.x is not None}
        assert set(got) == set(ref)
        assert all(abs(got[k] - ref[k]) < 1e-9 for k in ref)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


def _py_percentile(vals, q):
    vals = sorted(vals)
    pos = (len(vals) - 1) * q
    lo, hi = int(pos // 1), int(-(-pos // 1))
    return vals[lo] + (pos - lo) * (vals[hi] - vals[lo])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.05, 0.5, 0.95, 1.0]))
def test_property_discrete_quantile_and_average_rank(spark, rows, q):
    d = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "k long, g long, v long")
    got = {r.g: r.x for r in R.grouped_discrete_quantile(d, ["g"], "v", q, "x").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    assert all(abs(got[g] - _py_percentile(vs, q)) < 1e-9 for g, vs in groups.items())
    # average rank over all rows, nulls first, ties share the mean position
    avg = _by_key(R.global_rank(d, [F.col("v").asc_nulls_first()], ["v"], "x", average=True), "x")
    keyed = sorted(enumerate(rows), key=lambda t: (t[1][1] is not None, t[1][1] if t[1][1] is not None else 0))
    pos = {}
    for p, (i, (_, v)) in enumerate(keyed, start=1):
        pos.setdefault(v, []).append(p)
    want = {i: sum(pos[v]) / len(pos[v]) for i, (_, v) in enumerate(rows)}
    assert avg == want


def test_exact_quantiles_equal_percentile(spark):
    """Continuous, tied, constant, tiny and empty columns; wide ranges and infinities of scale; a sketch far coarser than the default."""
    import random
    r = random.Random(6)
    from tidewatch.operators.ranking import exact_quantiles
    rows = [(r.gauss(0, 1), float(r.randint(0, 3)), 5.0, 1.5 if k == 7 else None, r.choice([1e300, -1e300, 1e-300]) * r.random(), None) for k in range(20_000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(6)
    qs = [0.0, 0.05, 0.5, 0.95, 1.0, 0.333]
    cols = [F.col(c) for c in "abcdef"]
    for part in (df, df.limit(1), df.limit(2), df.limit(37), df.filter("a > 100")):
        part = part.persist()
        want = part.agg(*[F.percentile(c, F.array(*map(F.lit, qs))).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        for accuracy in (10_000, 50):
            got = spark.range(1).select(exact_quantiles(part, cols, qs, accuracy).alias("s")).first()["s"]
            for i in range(6):
                w = want[f"q{i}"]
                g = None if got is None else got[f"q{i}"]
                if w is None:
                    assert g is None or all(x is None for x in g)
                else:
                    assert all(abs(x - y) <= 1e-9 * max(abs(y), 1e-12) for x, y in zip(g, w)), (i, accuracy, g, w)
        part.unpersist()
