"""Properties from the test strategy: score ranges, the confidence adjustment
bound, scaling invariance of the normalisers, and composite weights."""
import math

import pytest
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.operators import scoring as sc
from tidewatch.operators.validation import composite_check

SF = "/root/testdata/sf0.001"


def test_composite_weights_sum_to_one():
    for w in (C.VULNERABILITY_WEIGHTS, C.RESILIENCE_WEIGHTS, C.READINESS_WEIGHTS, C.RECOVERY_WEIGHTS,
              C.CONFIDENCE_WEIGHTS, C.SPEC_STATION_WEIGHTS, C.SPEC_GAUGE_WEIGHTS, *C.PHASE_WEIGHTS.values()):
        assert composite_check(w), w


def test_scored_ranges_and_adjustment_bound(spark):
    from tidewatch.plans.areas import scored_indices
    rows = scored_indices(spark, SF).collect()
    assert rows
    for col in ("risk_index_raw", "hazard_combined", "response_readiness_index", "recovery_capacity_index", "priority_index",
                "confidence_score", "priority_index_conf_adj"):
        vals = [r[col] for r in rows if r[col] is not None]
        assert all(0.0 <= v <= 100.0 for v in vals), col
    prio = sorted(r.priority_index for r in rows)
    n = len(prio)
    med = (prio[(n - 1) // 2] + prio[n // 2]) / 2
    for r in rows:
        lo, hi = min(r.priority_index, med), max(r.priority_index, med)
        assert lo - 1e-9 <= r.priority_index_conf_adj <= hi + 1e-9


@pytest.mark.parametrize("scale,shift", [(3.0, 7.0), (0.01, -5.0)])
def test_normalisers_invariant_to_positive_affine_scaling(spark, scale, shift):
    vals = [float(v) for v in (3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, x double")
    df = df.withColumn("y", F.col("x") * scale + shift)
    out = sc.robust_scores(df, [("x", "rx", True), ("y", "ry", True)])
    out = sc.minmax_scores(out, [("x", "mx", False), ("y", "my", False)])
    for r in out.collect():
        for a, b in (("rx", "ry"), ("mx", "my")):
            if r[a] is None:
                assert r[b] is None
            else:
                assert math.isclose(r[a], r[b], rel_tol=1e-9, abs_tol=1e-9)
