"""Scoring operators: normalisers, composites, indices, confidence, bands.

Table-wide statistics (quantiles, min/max, median) are scalar subqueries
(``DataFrame.scalar()``): Spark runs them as a separate partial-aggregating
job and inlines the value, so no cross join and no driver round trip.
The percentile aggregate is only taken over area-level tables (one row per area, a
bounded dimension); ``large=True`` selects the same values without a buffer of
the column, ``approx=True`` switches to ``percentile_approx``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.numeric import clip, non_null_fraction, weighted_sum
from tidewatch.functions.timefn import hours_between


def robust_scores(df: DataFrame, specs, partition_by: list[str] | None = None,
                  approx: bool = False, large: bool = False) -> DataFrame:
    """D-07 for several columns: p05-p95 scaling to 0-100, degenerate bounds ->
    null, ``100 - s`` when higher is better.

    ``specs`` = [(col, out, higher_is_worse), ...].  All bounds come from one
    aggregate over ``df`` (one scalar subquery, or with ``partition_by`` one
    grouped aggregate joined back on the group key), so the plan stays linear
    in the number of scores.  ``large`` takes the same exact bounds by distributed
    selection (``ranking.exact_quantiles``), for tables of stations.
    """
    qs = [C.ROBUST_LO_Q, C.ROBUST_HI_Q]

    def q_agg(c):
        x = F.col(c).try_cast("double")
        return (F.percentile_approx(x, qs, 10000) if approx
                else F.percentile(x, F.array(*[F.lit(q) for q in qs])))

    aggs = [q_agg(c).alias(f"_q{i}") for i, (c, _, _) in enumerate(specs)]
    if partition_by:
        b = df.groupBy(*partition_by).agg(*aggs)
        df = df.join(b, partition_by, "left")
        bounds = [F.col(f"_q{i}") for i in range(len(specs))]
    elif large:
        from tidewatch.operators.ranking import exact_quantiles
        df = df.withColumn("_st", exact_quantiles(df, [F.col(c) for c, _, _ in specs], qs))
        bounds = [F.col(f"_st.q{i}") for i in range(len(specs))]
    else:
        # attach the one-row statistics once; columns below reference the
        # attached column, so the subquery plan is embedded a single time
        df = df.withColumn("_st", df.select(F.struct(*aggs)).scalar())
        bounds = [F.col(f"_st._q{i}") for i in range(len(specs))]
    cols = {}
    for (c, out, worse), b in zip(specs, bounds):
        x = F.col(c).try_cast("double")
        lo, hi = b[0].cast("double"), b[1].cast("double")
        s = F.when(lo.isNotNull() & hi.isNotNull() & (hi > lo),
                   clip((x - lo) / (hi - lo), 0.0, 1.0) * F.lit(100.0))
        cols[out] = s if worse else F.lit(100.0) - s
    df = df.withColumns(cols)
    return df.drop(*[f"_q{i}" for i in range(len(specs))]) if partition_by else df.drop("_st")


def robust_score(df: DataFrame, col: str, out: str, higher_is_worse: bool = True,
                 partition_by: list[str] | None = None, approx: bool = False) -> DataFrame:
    """D-07 for one column (see ``robust_scores``)."""
    return robust_scores(df, [(col, out, higher_is_worse)], partition_by, approx)


def minmax_scores(df: DataFrame, specs) -> DataFrame:
    """D-08 for several columns: (x - min) / (max - min) in 0-1, degenerate ->
    null, ``1 - s`` when inverted.  ``specs`` = [(col, out, invert), ...];
    one aggregate for all bounds."""
    aggs = []
    for i, (c, _, _) in enumerate(specs):
        x = F.col(c).try_cast("double")
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    df = df.withColumn("_st", df.select(F.struct(*aggs)).scalar())
    cols = {}
    for i, (c, out, invert) in enumerate(specs):
        x = F.col(c).try_cast("double")
        lo, hi = F.col(f"_st.lo{i}"), F.col(f"_st.hi{i}")
        s = F.when(lo.isNotNull() & hi.isNotNull() & (hi != lo), (x - lo) / (hi - lo))
        if invert:
            s = F.lit(1.0) - s
        cols[out] = clip(s, 0.0, 1.0)
    return df.withColumns(cols).drop("_st")


def zscore(df: DataFrame, col: str, out: str) -> DataFrame:
    """SP-26: (x - mean) / stddev over the table; zero spread -> null."""
    x = F.col(col).cast("double")
    df = df.withColumn("_st", df.select(F.struct(F.avg(x).alias("mu"), F.stddev_samp(x).alias("sd"))).scalar())
    return df.withColumn(out, F.try_divide(x - F.col("_st.mu"), F.col("_st.sd"))).drop("_st")


def quantile_score(df: DataFrame, col: str, out: str, order_key: str) -> DataFrame:
    """SP-26: percent rank x 100 over (col asc nulls last, order_key); rows tie
    only when both are equal.  Distributed (``ranking.global_percent_rank``)."""
    from tidewatch.operators.ranking import global_percent_rank
    r = global_percent_rank(df, [F.col(col).asc_nulls_last(), F.col(order_key)], [col, order_key], "_pr")
    return r.withColumn(out, F.when(F.col(col).isNotNull(), F.col("_pr") * 100.0)).drop("_pr")


def band(score: Column) -> Column:
    """D-24: Red >= 85, Orange >= 70, Yellow >= 50, else Green (null -> Green)."""
    out = None
    for name, lo in C.BANDS:
        out = F.when(score >= lo, F.lit(name)) if out is None else out.when(score >= lo, F.lit(name))
    return out.otherwise(F.lit(C.BAND_ELSE))


def with_area_composites(df: DataFrame, income_direction: str = "code") -> DataFrame:
    """D-12, D-13, D-14 from the robust component scores (P10).

    ``income_direction="code"`` reproduces Q1 (income score already inverted,
    then inverted again in the composites); "intended" uses the direct score.
    """
    inc = F.col("income_capacity_score")
    if income_direction == "intended":
        inc = F.lit(100.0) - inc
    vw, rw = C.VULNERABILITY_WEIGHTS, C.RESILIENCE_WEIGHTS
    vuln = weighted_sum([("poverty_score", vw["poverty"]), ("transport_constraint_score", vw["transport"]),
                         ("housing_fragility_score", vw["housing"]), (F.lit(100.0) - inc, vw["income_inv"])])
    res = weighted_sum([(inc, rw["income"]), (F.lit(100.0) - F.col("transport_constraint_score"), rw["transport_inv"]),
                        (F.lit(100.0) - F.col("housing_fragility_score"), rw["housing_inv"])])
    return (df.withColumn("exposure_score", F.col("exposure_population_score"))
              .withColumn("vulnerability_score", vuln)
              .withColumn("resilience_capacity_score", clip(res, 0.0, 100.0)))


def _filled(col: str) -> Column:
    return F.least(F.greatest(F.coalesce(F.col(col).try_cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(100.0))


def with_operational_indices(df: DataFrame, phase: str = C.DEFAULT_PHASE) -> DataFrame:
    """D-18 .. D-21: risk, readiness, recovery, phase-weighted priority (P30)."""
    phase = (phase or C.DEFAULT_PHASE).upper().strip()
    if phase not in C.PHASE_WEIGHTS:
        phase = C.DEFAULT_PHASE
    h, e, v, r = _filled("hazard_combined"), _filled("exposure_score"), _filled("vulnerability_score"), \
        _filled("resilience_capacity_score")
    rw, cw, pw = C.READINESS_WEIGHTS, C.RECOVERY_WEIGHTS, C.PHASE_WEIGHTS[phase]
    hundred = F.lit(100.0)
    df = df.withColumns({
        "_h": h, "_e": e, "_v": v, "_r": r,
    })
    df = df.withColumns({
        "risk_index_raw": (F.col("_h") / 100.0) * (F.col("_e") / 100.0) * (F.col("_v") / 100.0) * 100.0,
        "resilience_index": F.col("_r"),
        "response_readiness_index": clip(weighted_sum([(hundred - F.col("_h"), rw["hazard_inv"]),
                                                       (F.col("_r"), rw["resilience"]),
                                                       (hundred - F.col("_v"), rw["vulnerability_inv"])]), 0.0, 100.0),
        "recovery_capacity_index": clip(weighted_sum([(F.col("_r"), cw["resilience"]),
                                                      (hundred - F.col("_e"), cw["exposure_inv"]),
                                                      (hundred - F.col("_v"), cw["vulnerability_inv"])]), 0.0, 100.0),
    })
    df = df.withColumn("priority_index", clip(weighted_sum([
        ("risk_index_raw", pw["risk"]),
        (hundred - F.col("response_readiness_index"), pw["rr"]),
        (hundred - F.col("recovery_capacity_index"), pw["rc"])]), 0.0, 100.0))
    return df.withColumn("phase", F.lit(phase))


def with_confidence(df: DataFrame, as_of: Column, latest_obs_col: str = "noaa_latest_obs_utc") -> DataFrame:
    """D-22: freshness, completeness, validity, crosscheck -> confidence score.

    Validity uses the filled and clipped inputs, so it is always 100 (Q8).
    """
    age = hours_between(as_of, F.col(latest_obs_col))
    freshness = clip(F.lit(100.0) - (F.least(F.greatest(F.coalesce(age, F.lit(C.FRESHNESS_HOURS)), F.lit(0.0)),
                                             F.lit(C.FRESHNESS_HOURS)) / C.FRESHNESS_HOURS) * 100.0, 0.0, 100.0)
    completeness = non_null_fraction("hazard_combined", "exposure_score", "vulnerability_score",
                                     "resilience_capacity_score") * 100.0
    valid = (F.col("_h").between(0, 100) & F.col("_e").between(0, 100) & F.col("_v").between(0, 100))
    validity = valid.cast("double") * 100.0
    hit = (F.coalesce(F.col("flood_hazard_muni"), F.lit(0.0)) > 0) | \
          (F.coalesce(F.col("earthquake_hazard_score"), F.lit(0.0)) > 0)
    crosscheck = F.when(hit, F.lit(C.CROSSCHECK_HIT)).otherwise(F.lit(C.CROSSCHECK_MISS))
    w = C.CONFIDENCE_WEIGHTS
    conf = clip(weighted_sum([(freshness, w["freshness"]), (completeness, w["completeness"]),
                              (validity, w["validity"]), (crosscheck, w["crosscheck"])]), 0.0, 100.0)
    return (df.withColumn("confidence_score", conf)
              .withColumn("confidence_0_1", clip(F.col("confidence_score") / 100.0, 0.0, 1.0)))


def with_confidence_adjustment(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """D-23: c * priority + (1 - c) * median(priority), the median over the table or per ``partition_by`` group."""
    if partition_by:
        df = df.join(df.groupBy(*partition_by).agg(F.median("priority_index").cast("double").alias("_med")), partition_by, "left")
    else:
        df = df.withColumn("_med", df.select(F.median("priority_index").cast("double")).scalar())
    c = F.col("confidence_0_1")
    return (df.withColumn("priority_index_conf_adj", c * F.col("priority_index") + (F.lit(1.0) - c) * F.col("_med"))
              .drop("_med"))


def with_bands(df: DataFrame) -> DataFrame:
    """D-24 + D-25: band, then hard red when alert >= 95 or flood >= 90."""
    hard = ((F.coalesce(F.col("nws_global_alert_score"), F.lit(0.0)) >= C.HARD_RED_ALERT)
            | (F.coalesce(F.col("flood_hazard_muni"), F.lit(0.0)) >= C.HARD_RED_FLOOD))
    return df.withColumn("priority_band", F.when(hard, F.lit("Red")).otherwise(band(F.col("priority_index_conf_adj"))))


def recommended_actions(df: DataFrame) -> Column:
    """D-26: rule actions in order, de-duplicated, joined with ' | '; default when none."""
    items = []
    for col, op, thr, text in C.ACTION_RULES:
        c = F.col(col)
        cond = c >= thr if op == ">=" else c <= thr
        items.append(F.when(cond, F.lit(text)))
    acts = F.array_distinct(F.array_compact(F.array(*items)))
    return F.when(F.size(acts) > 0, F.array_join(acts, C.ACTION_SEPARATOR)).otherwise(F.lit(C.ACTION_DEFAULT))


SCORED_COLUMNS = [
    "municipio", "municipio_key", "latitude", "longitude",
    "hazard_combined", "flood_hazard_muni", "earthquake_hazard_score",
    "exposure_score", "vulnerability_score", "resilience_index",
    "response_readiness_index", "recovery_capacity_index",
    "risk_index_raw", "priority_index", "priority_index_conf_adj",
    "confidence_score", "confidence_0_1", "priority_band", "phase",
]
