"""Validation operators (A-09, A-10, A-19, A-20, SP-21 .. SP-25).

All inputs here are area-level tables (one row per area), so global windows
(ranks, ntile) run on a bounded dimension.  Replicated scenario rows (dropout
levels, weight scenarios) are produced with ``explode`` of a literal array per
row -- a fixed, small fan-out per area -- and folded by grouped aggregates.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.numeric import clip, weighted_sum


def dropout_mask(key: Column, fraction: float) -> Column:
    """Deterministic pseudo-random mask on an integer key (Q11): ~fraction of keys."""
    return F.pmod(key * 37 + 11, F.lit(100)) < F.lit(int(round(fraction * 100)))


def index_metrics(scored: DataFrame, col: str = "priority_index_conf_adj", band_col: str = "priority_band",
                  key: str = "area_id", stress_fraction: float = 0.30) -> DataFrame:
    """A-20: long (metric, value) table of the P40 checks.

    row_count, null rate, min / max / mean, band_count_<band> per band value
    (missing -> 'nan'), and the 30 % stress MAE (masked values replaced by the
    median of the masked values).
    """
    x = F.col(col)
    wide = scored.agg(
        F.count(F.lit(1)).cast("double").alias("row_count"),
        F.avg(x.isNull().cast("double")).alias(f"null_rate_{col}"),
        F.min(x).alias("priority_min"),
        F.max(x).alias("priority_max"),
        F.avg(x).alias("priority_mean"),
    )
    names = wide.columns
    long1 = wide.unpivot([], names, "metric", "value")
    bands = (scored.groupBy(F.coalesce(F.col(band_col), F.lit("nan")).alias("_b"))
             .agg(F.count(F.lit(1)).cast("double").alias("value"))
             .select(F.concat(F.lit("band_count_"), F.col("_b")).alias("metric"), "value"))
    mask = dropout_mask(F.col(key), stress_fraction)
    s = scored.withColumn("_m", mask)
    s = s.withColumn("_med", s.select(F.median(F.when(F.col("_m"), x))).scalar())
    stressed = F.when(F.col("_m"), F.col("_med")).otherwise(x)
    mae = s.agg(F.avg(F.abs(x - stressed)).alias("value")).select(
        F.lit("stress_test_mae_priority").alias("metric"), "value")
    return long1.unionByName(bands).unionByName(mae)


def average_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """Rank 1..n ascending (nulls first, as ``rank()``) with ties sharing the
    average rank; null values get a null rank.  Distributed
    (``ranking.global_rank``), no single-partition window."""
    from tidewatch.operators.ranking import global_rank
    d = global_rank(df, [F.col(col).asc_nulls_first()], [col], "_avg", average=True)
    return d.withColumn(out, F.when(F.col(col).isNotNull(), F.col("_avg"))).drop("_avg")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """SP-21: Spearman rank correlation (average ranks over rows where both are present)."""
    d = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    d = average_rank(average_rank(d, a, "_ra"), b, "_rb")
    return d.agg(F.corr("_ra", "_rb").alias("spearman_rank_corr"), F.count(F.lit(1)).alias("n"))


def red_band_precision_recall(df: DataFrame, band_col: str = "priority_band", outcome_col: str = "impact_observed"):
    """SP-22: precision / recall of the Red band against the observed outcome."""
    red = F.col(band_col) == "Red"
    hit = F.coalesce(F.col(outcome_col) == 1, F.lit(False))
    agg = df.agg(
        F.count_if(red & hit).alias("true_positive"),
        F.count_if(red & ~hit).alias("false_escalation"),
        F.count_if(~red & hit).alias("missed"),
    )
    return agg.select("*",
                      F.try_divide(F.col("true_positive"), F.col("true_positive") + F.col("false_escalation"))
                      .cast("double").alias("precision"),
                      F.try_divide(F.col("true_positive"), F.col("true_positive") + F.col("missed"))
                      .cast("double").alias("recall"))


def fairness_by_quartile(df: DataFrame, vuln_col: str = "vulnerability_score", pop_col: str = "population",
                         band_col: str = "priority_band", key: str = "area_id") -> DataFrame:
    """SP-24: red share per vulnerability quartile against the population share."""
    from tidewatch.operators.ranking import global_ntile
    d = global_ntile(df, [F.col(vuln_col).asc_nulls_first(), F.col(key)], 4, "vulnerability_quartile")
    tot = d.select(F.sum(pop_col)).scalar()
    agg = d.groupBy("vulnerability_quartile").agg(
        F.count(F.lit(1)).alias("areas"),
        F.count_if(F.col(band_col) == "Red").alias("red_count"),
        F.sum(pop_col).alias("_pop"),
    )
    return agg.select(
        "vulnerability_quartile", "areas", "red_count",
        (F.col("red_count") / F.col("areas")).alias("red_share"),
        F.try_divide(F.col("_pop"), tot).alias("population_share"),
    )


def priority_from_components(risk: Column, rr: Column, rc: Column, w_risk, w_rr, w_rc) -> Column:
    return clip(risk * w_risk + (F.lit(100.0) - rr) * w_rr + (F.lit(100.0) - rc) * w_rc, 0.0, 100.0)


def weight_sensitivity(scored: DataFrame, phase: str = C.DEFAULT_PHASE, key: str = "area_id",
                       deltas=C.SPEC_SENSITIVITY_DELTAS) -> DataFrame:
    """SP-25: scale one phase weight by (1 + delta), renormalise, recompute the
    priority index, and compare ranks with the base (Spearman, max rank shift)."""
    base = C.PHASE_WEIGHTS[phase]
    scen = []
    for comp in ("risk", "rr", "rc"):
        for dlt in deltas:
            w = dict(base)
            w[comp] = w[comp] * (1 + dlt)
            tot = sum(w.values())
            scen.append(F.struct(F.lit(comp).alias("component"), F.lit(float(dlt)).alias("delta"),
                                 F.lit(w["risk"] / tot).alias("w_risk"), F.lit(w["rr"] / tot).alias("w_rr"),
                                 F.lit(w["rc"] / tot).alias("w_rc")))
    d = scored.select(key, "risk_index_raw", "response_readiness_index", "recovery_capacity_index",
                      "priority_index", F.explode(F.array(*scen)).alias("s"))
    d = d.withColumn("p_new", priority_from_components(F.col("risk_index_raw"), F.col("response_readiness_index"),
                                                       F.col("recovery_capacity_index"), F.col("s.w_risk"),
                                                       F.col("s.w_rr"), F.col("s.w_rc")))
    # each scenario is a full copy of the area table: ranks per scenario come
    # from one distributed row number over (scenario, order), not a window
    from tidewatch.operators.ranking import row_number_within
    d = d.select(key, "priority_index", "p_new", F.col("s.component").alias("component"),
                 F.col("s.delta").alias("delta"))
    grp = ["component", "delta"]
    d = row_number_within(d, grp, [F.col("priority_index").desc(), F.col(key)], "_rb")
    d = row_number_within(d, grp, [F.col("p_new").desc(), F.col(key)], "_rn")
    return d.groupBy("component", "delta").agg(
        F.corr(F.col("_rb").cast("double"), F.col("_rn").cast("double")).alias("spearman_rank_corr"),
        F.max(F.abs(F.col("_rb") - F.col("_rn"))).cast("long").alias("max_rank_shift"),
    )


def dropout_stability(scored_inputs: DataFrame, as_of: Column, phase: str = C.DEFAULT_PHASE,
                      key: str = "area_id", levels=C.SPEC_DROPOUT_LEVELS) -> DataFrame:
    """SP-23: drop the hazard input for a fraction of areas, recompute the
    indices, confidence and adjustment per level; MAE against the full result.

    ``scored_inputs`` is the joined features + hazard table (before scoring).
    """
    from tidewatch.operators import scoring as sc
    full = sc.with_confidence(sc.with_operational_indices(scored_inputs, phase), as_of)
    full = sc.with_confidence_adjustment(full).select(key, F.col("priority_index_conf_adj").alias("_base"))
    lv = scored_inputs.withColumn("level", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    masked = reduce(lambda acc, x: acc.when(F.col("level") == x, dropout_mask(F.col(key), x)),
                    levels[1:], F.when(F.col("level") == levels[0], dropout_mask(F.col(key), levels[0])))
    lv = lv.withColumn("hazard_combined", F.when(masked, F.lit(None).cast("double")).otherwise(F.col("hazard_combined")))
    s = sc.with_confidence(sc.with_operational_indices(lv, phase), as_of)
    med = s.groupBy("level").agg(F.median("priority_index").alias("_med"))
    s = s.join(F.broadcast(med), "level")
    c = F.col("confidence_0_1")
    s = s.withColumn("adj", c * F.col("priority_index") + (F.lit(1.0) - c) * F.col("_med"))
    s = s.join(full, key)
    return s.groupBy("level").agg(
        F.avg(F.abs(F.col("adj") - F.col("_base"))).alias("mae_priority"),
        F.count_if(masked).alias("dropped_areas"),
    )


def composite_check(weights: dict[str, float], tol: float = 1e-9) -> bool:
    """SP-06 guard: weights must sum to one."""
    return abs(sum(weights.values()) - 1.0) <= tol
