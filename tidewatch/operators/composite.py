"""Spec-declared composite operators (SP-05 .. SP-11, SP-20, SP-26).

The generic composite works on a long table ``(entity, indicator, value)``:
indicator metadata (index, weight, direction, bounds policy, fixed bounds)
is a small broadcast table built from the spec; percentile bounds are a
grouped aggregate per indicator over the entity dimension; the index is a
grouped weighted sum.  Weights are checked to sum to one per index before
any job runs.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import config as C
from tidewatch.functions.numeric import clip, weighted_sum

META_SCHEMA = T.StructType([
    T.StructField("indicator", T.StringType()),
    T.StructField("index", T.StringType()),
    T.StructField("w", T.DoubleType()),
    T.StructField("direction", T.StringType()),   # higher_worse | higher_better | lower_better
    T.StructField("policy", T.StringType()),      # thresholds | percentiles | fixed
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
])


def indicator_meta(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    by_index: dict[str, float] = {}
    for r in rows:
        by_index[r[1]] = by_index.get(r[1], 0.0) + r[2]
    bad = {k: v for k, v in by_index.items() if abs(v - 1.0) > 1e-9}
    if bad:
        raise ValueError(f"weights must sum to 1 per index: {bad}")
    return spark.createDataFrame(rows, META_SCHEMA)


def normalise_indicators(long: DataFrame, meta: DataFrame, entity: str = "area_id") -> DataFrame:
    """SP-07: bounds by precedence thresholds -> percentiles -> fixed, clip to
    0-100, direction applied ("higher_better" becomes a gap score 100 - s).

    Threshold bounds come with the rows (``thr_lo``/``thr_hi`` columns, may be
    null); percentile bounds are p05/p95 of the indicator over all entities.
    """
    m = F.broadcast(meta)
    j = long.join(m, "indicator")
    pct = (long.groupBy("indicator")
           .agg(F.percentile(F.col("value"), F.array(F.lit(C.ROBUST_LO_Q), F.lit(C.ROBUST_HI_Q))).alias("_p")))
    j = j.join(pct, "indicator", "left")
    has_thr = [c for c in ("thr_lo", "thr_hi") if c in long.columns]
    thr_lo = F.col("thr_lo") if has_thr else F.lit(None).cast("double")
    thr_hi = F.col("thr_hi") if has_thr else F.lit(None).cast("double")
    use_thr = (F.col("policy") == "thresholds") & thr_lo.isNotNull() & thr_hi.isNotNull()
    use_pct = (F.col("policy").isin("thresholds", "percentiles")) & F.col("_p").isNotNull()
    lo = F.when(use_thr, thr_lo).when(use_pct, F.col("_p")[0]).otherwise(F.col("lo"))
    hi = F.when(use_thr, thr_hi).when(use_pct, F.col("_p")[1]).otherwise(F.col("hi"))
    x = F.col("value")
    s = F.when(x.isNotNull() & lo.isNotNull() & hi.isNotNull() & (hi > lo),
               clip((x - lo) / (hi - lo), 0.0, 1.0) * F.lit(100.0))
    s = F.when(F.col("direction") == "higher_better", F.lit(100.0) - s).otherwise(s)
    return j.select(entity, "indicator", "index", "w", "value", s.alias("score"))


def composite(scored_long: DataFrame, entity: str = "area_id", invert=()) -> DataFrame:
    """SP-06: sum(w * s) per (entity, index); indexes named in ``invert`` are
    reported as 100 - sum (SP-08 resilience = 100 - ICS, SP-09)."""
    agg = scored_long.groupBy(entity, "index").agg(
        F.sum(F.col("w") * F.col("score")).alias("weighted_sum"),
        F.sum(F.when(F.col("score").isNotNull(), F.col("w"))).alias("weight_present"),
    )
    inv = F.col("index").isin(*invert) if invert else F.lit(False)
    return agg.withColumn("index_value", F.when(inv, F.lit(100.0) - F.col("weighted_sum"))
                          .otherwise(F.col("weighted_sum")))


def top_drivers(scored_long: DataFrame, k: int = 3, entity: str = "area_id") -> DataFrame:
    """SP-20: the k largest w * s contributions per (entity, index)."""
    c = scored_long.withColumn("contribution", F.col("w") * F.col("score")).filter(F.col("contribution").isNotNull())
    w = Window.partitionBy(entity, "index").orderBy(F.col("contribution").desc(), F.col("indicator"))
    return (c.withColumn("driver_rank", F.row_number().over(w).cast("long"))
             .filter(F.col("driver_rank") <= k)
             .select(entity, "index", "driver_rank", "indicator", "contribution"))


def confidence_tier(conf: Column) -> Column:
    return F.when(conf >= 80, "high").when(conf >= 60, "medium").otherwise("low")


def priority_drivers(scored: DataFrame, phase: str = C.DEFAULT_PHASE, k: int = 3,
                     entity: str = "area_id") -> DataFrame:
    """SP-20 on the coded priority index: contributions of risk, readiness gap
    and recovery gap, ranked per area, with the confidence tier."""
    pw = C.PHASE_WEIGHTS[phase]
    parts = F.array(
        F.struct(F.lit("risk_index_raw").alias("indicator"),
                 (F.col("risk_index_raw") * pw["risk"]).alias("contribution")),
        F.struct(F.lit("response_readiness_gap").alias("indicator"),
                 ((F.lit(100.0) - F.col("response_readiness_index")) * pw["rr"]).alias("contribution")),
        F.struct(F.lit("recovery_capacity_gap").alias("indicator"),
                 ((F.lit(100.0) - F.col("recovery_capacity_index")) * pw["rc"]).alias("contribution")),
    )
    d = scored.select(entity, "confidence_score", F.inline(parts))
    w = Window.partitionBy(entity).orderBy(F.col("contribution").desc(), F.col("indicator"))
    return (d.withColumn("driver_rank", F.row_number().over(w).cast("long")).filter(F.col("driver_rank") <= k)
             .select(entity, "driver_rank", "indicator", "contribution",
                     confidence_tier(F.col("confidence_score")).alias("confidence_tier")))


def weighted_risk(df: DataFrame, phase: str = "DURING") -> DataFrame:
    """SP-05: risk as the spec's weighted sum of H, E, V for the phase profile."""
    w = C.SPEC_RISK_PHASE_WEIGHTS[phase]

    def f(c):
        return F.least(F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)), F.lit(100.0))
    return df.withColumn("risk_weighted", weighted_sum([(f("hazard_combined"), w["hazard"]),
                                                        (f("exposure_score"), w["exposure"]),
                                                        (f("vulnerability_score"), w["vulnerability"])]))


def spec_vulnerability(df: DataFrame) -> DataFrame:
    """SP-10: access = 0.7 no-vehicle % + 0.3 single-route %, then
    vulnerability = 0.60 SVI + 0.25 access (percentile-scored) + 0.15 housing."""
    from tidewatch.operators.scoring import robust_scores
    aw, vw = C.SPEC_ACCESS_WEIGHTS, C.SPEC_VULNERABILITY_WEIGHTS
    df = df.withColumn("access_constraints", weighted_sum([("no_vehicle_pct", aw["no_vehicle_pct"]),
                                                          ("single_route_fragility_pct",
                                                           aw["single_route_fragility_pct"])]))
    df = robust_scores(df, [("access_constraints", "access_score", True),
                            ("housing_burden_pct", "housing_score", True)])
    svi = clip(F.col("svi_overall"), 0.0, 1.0) * F.lit(100.0)
    return df.withColumn("svi_score", svi).withColumn(
        "vulnerability_spec", weighted_sum([(F.col("svi_score"), vw["svi_overall"]),
                                            ("access_score", vw["access_constraints"]),
                                            ("housing_score", vw["housing_fragility"])]))
