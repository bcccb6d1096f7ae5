"""S-14: repeated keys, found by tasks of a bounded number of rows."""
from collections import Counter

from tidewatch.sources import envelopes as env


def test_keys_are_dealt_to_as_many_tasks_as_the_rows_ask_for(spark, monkeypatch):
    """A key of a third of the rows, null keys (alone and in pairs), distinct ones, and columns that are no keys."""
    monkeypatch.setattr(env, "KEY_TASK_ROWS", 50)
    rows = [(7, "x", k) if k % 3 == 0 else (None, None if k % 100 == 1 else "n", k) if k % 50 == 1 else (k, "y" if k % 5 else None, k) for k in range(6_000)] + [(10, None, 1)] * 2
    df = spark.createDataFrame(rows, "a long, b string, other long")
    got = env.key_violations(df, ["a", "b"])
    want = {k: n for k, n in Counter((a, b) for a, b, _ in rows).items() if n > 1}
    assert got.columns == ["a", "b", "count"] and {(r.a, r.b): r["count"] for r in got.collect()} == want and len(want) == 4
    assert got.rdd.getNumPartitions() >= 6_000 // 50
    assert env.key_violations(df.filter("false"), ["a"]).count() == 0
