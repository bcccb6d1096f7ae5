"""Global ranks without a single-partition window.

``Window.orderBy(...)`` with no partition moves the whole table into one
task.  Here a global row number is built from a distributed sort instead:

1. ``orderBy`` range-partitions and sorts the rows; ``monotonically_increasing_id``
   then numbers them in sort order inside each partition (partition index in
   the upper bits, position in the lower 33 bits).
2. The numbered table is written once to the checkpoint folder, so the ids are
   fixed (a recomputation cannot renumber them) and lineage is cut.
3. Per-partition row counts (one row per partition, a bound set by the
   shuffle partition count) give each partition's offset; the offsets are
   broadcast (bounded by the partition count by construction) and added to
   the in-partition position.

Ranks with ties (``rank``, average rank), ``percent_rank`` and ``ntile`` are
derived from the row number with group-bys and scalar subqueries, all of
which aggregate map-side.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import stage_checkpoint

_POS_BITS = 33
#: Accuracy of the sketch that brackets a quantile: its ranks are right to one part in this many.
BRACKET_ACCURACY = 10_000
#: Join keys that the rows of one hot key are spread over.
SALTS = 32


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """``row_number() over (order by <order>)`` as a distributed computation.

    Give a total order (end with a unique key) for a deterministic result,
    exactly as with the window function.
    """
    s = df.orderBy(*order).withColumn("_gid", F.monotonically_increasing_id())
    s = stage_checkpoint(s, "rownum")
    s = s.withColumn("_pid", F.shiftright(F.col("_gid"), _POS_BITS))
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition of the sort: bounded by the partition count by
    # construction, so the broadcast needs no data-dependent size check
    s = s.join(F.broadcast(offs), "_pid")
    pos = F.col("_gid") - F.shiftleft(F.col("_pid"), _POS_BITS)
    return s.withColumn(out, (F.col("_off") + pos + F.lit(1)).cast("long")).drop("_gid", "_pid", "_off")


def join_stats(rows: DataFrame, stats: DataFrame, cols: list[str], stat_cols: list[str], spread: str,
               how: str = "left", salts: int = SALTS) -> DataFrame:
    """Rows joined to the one statistics row of their ``cols`` (named ``stat_cols`` there, dropped after).

    A key may hold a third of all rows, and the skew rule does not split a
    join whose other side is an aggregate over its own shuffle: rows are
    therefore spread over ``salts`` join keys by the column ``spread``, and each
    statistics row is repeated once per salt.  Null keys match each other.
    """
    r = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    s = stats.withColumn("_stat_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(cols, stat_cols)] + [F.col("_salt") == F.col("_stat_salt")]
    return r.join(s, cond, how).drop("_salt", "_stat_salt", *stat_cols)


def _tie_stats(ranked: DataFrame, rn: str, tie_cols: list[str]) -> DataFrame:
    """Per group of equal ``tie_cols`` values: the first row number and the size.

    The group-by aggregates map-side; the join back is salted, since a tie
    group may hold most rows.
    """
    keys = [f"_tk{i}" for i in range(len(tie_cols))]
    stats = ranked.groupBy(*tie_cols).agg(F.min(rn).alias("_g_first"), F.count(F.lit(1)).alias("_g_ties"))
    stats = stats.select(*[F.col(c).alias(k) for c, k in zip(tie_cols, keys)], "_g_first", "_g_ties")
    return join_stats(ranked, stats, tie_cols, keys, rn)


def global_rank(df: DataFrame, order: list[Column], tie_cols: list[str], out: str = "rank",
                average: bool = False) -> DataFrame:
    """``rank()`` over ``order`` where rows with equal ``tie_cols`` tie (the
    order's leading columns); ``average=True`` gives the average rank of the
    tie group instead of its lowest rank."""
    r = global_row_number(df, order, "_g_rn")
    r = _tie_stats(r, "_g_rn", tie_cols)
    first, ties = F.col("_g_first"), F.col("_g_ties")
    val = first.cast("double") + (ties - F.lit(1)) / F.lit(2.0) if average else first
    return r.withColumn(out, val).drop("_g_rn", "_g_first", "_g_ties")


def global_percent_rank(df: DataFrame, order: list[Column], tie_cols: list[str], out: str = "percent_rank"
                        ) -> DataFrame:
    """``percent_rank()``: (rank - 1) / (n - 1), 0 for a single row."""
    r = global_rank(df, order, tie_cols, "_g_rk")
    n = r.select(F.count(F.lit(1))).scalar()
    pr = F.when(n > 1, (F.col("_g_rk") - F.lit(1)).cast("double") / (n - F.lit(1)).cast("double"))
    pr = pr.otherwise(F.lit(0.0))
    return r.withColumn(out, pr).drop("_g_rk")


def global_ntile(df: DataFrame, order: list[Column], k: int, out: str = "ntile") -> DataFrame:
    """``ntile(k)``: k buckets in order, the first ``n % k`` one row larger."""
    r = global_row_number(df, order, "_g_rn")
    n = r.select(F.count(F.lit(1))).scalar()
    q, rem = F.floor(n / F.lit(k)), n % F.lit(k)
    rn = F.col("_g_rn")
    big = rem * (q + F.lit(1))
    tile = (F.when(rn <= big, F.floor((rn - F.lit(1)) / (q + F.lit(1))) + F.lit(1))
            .otherwise(rem + F.floor((rn - F.lit(1) - big) / q) + F.lit(1)))
    return r.withColumn(out, tile.cast("long")).drop("_g_rn")


def row_number_within(df: DataFrame, group_cols: list[str], order: list[Column], out: str = "row_number"
                      ) -> DataFrame:
    """``row_number() over (partition by group order by ...)`` for groups that
    may each be a whole table (e.g. one copy per scenario): one global row
    number over (group, order), minus the group's first number."""
    r = global_row_number(df, [F.col(c) for c in group_cols] + order, "_g_rn")
    r = _tie_stats(r, "_g_rn", group_cols)
    within = (F.col("_g_rn") - F.col("_g_first") + F.lit(1)).cast("long")
    return r.withColumn(out, within).drop("_g_rn", "_g_first", "_g_ties")


def grouped_discrete_quantiles(df: DataFrame, keys: list[str], value: str, qs: list[float], outs: list[str],
                               weight: str | None = None) -> DataFrame:
    """Exact ``percentile(value, q)`` per key for each q (linear interpolation,
    nulls ignored) for *discrete* values -- whole minutes, counts, readings at
    a fixed instrument resolution.

    A percentile aggregate keeps every value of its group in one buffer; here
    the rows are first reduced to (key, value, count) by a partial aggregate,
    so a key holding a third of all rows ships one row per distinct value per
    map task.  A running count per key over its distinct values (bounded by
    the value domain, not by the row count) then locates the two order
    statistics around position (n - 1) * q; all quantiles come from one pass.
    Returns one row per key with at least one value.  For continuous values
    use ``percentile_approx``.  ``weight`` names a row-count column when
    ``df`` is already pre-aggregated.
    """
    v = F.col(value)
    w = F.col(weight) if weight else F.lit(1)
    counts = df.filter(v.isNotNull()).groupBy(*keys, value).agg(F.sum(w).cast("long").alias("_c"))
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("_cum", F.sum("_c").over(upto))
    c = c.withColumn("_n", F.max("_cum").over(Window.partitionBy(*keys)))

    def covers(k):  # 0-based index k falls in this value's run of rows
        return (F.col("_cum") - F.col("_c") <= k) & (F.col("_cum") > k)

    aggs = []
    for i, q in enumerate(qs):
        pos = (F.col("_n") - F.lit(1)).cast("double") * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when(covers(lo), v)).cast("double").alias(f"_lo{i}"),
                 F.max(F.when(covers(hi), v)).cast("double").alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_f{i}")]
    agg = c.groupBy(*keys).agg(*aggs)
    vals = [(F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(o)
            for i, o in enumerate(outs)]
    return agg.select(*keys, *vals)


def grouped_discrete_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str,
                              weight: str | None = None) -> DataFrame:
    """One quantile of ``grouped_discrete_quantiles``."""
    return grouped_discrete_quantiles(df, keys, value, [q], [out], weight)


def exact_quantiles(df: DataFrame, columns: list[Column], qs: list[float], accuracy: int = BRACKET_ACCURACY) -> Column:
    """Scalar struct of ``q0``, ``q1``, ...: per column the array of its ``percentile(column, qs)``, null without a value.

    The percentile aggregate keeps every distinct value of the table in one buffer.
    Here a mergeable sketch, whose rank error is guaranteed, brackets each quantile
    first; then rows below the bracket are counted, and rows inside it are
    counted per value, both map-side.  Only the values inside, about 4 / accuracy of
    the rows, meet in one sort, where the running count finds the two order
    statistics.  Two scans, one plan, nothing on the driver.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), c.try_cast("double").alias("v")) for i, c in enumerate(columns)]))
    long = df.select(pairs.alias("p")).select("p.*").filter(F.col("v").isNotNull())
    slack = 2.0 / accuracy
    marks = [m for q in qs for m in (max(0.0, q - slack), min(1.0, q + slack))]
    # one row per column
    sketch = long.groupBy(F.col("i").alias("_i")).agg(F.percentile_approx("v", marks, accuracy).alias("_m"), F.count(F.lit(1)).alias("_n"))
    k = F.explode(F.array(*[F.struct(F.lit(j).alias("k"), F.lit(float(q)).alias("q")) for j, q in enumerate(qs)]))
    s = sketch.select("_i", "_n", "_m", k.alias("_k")).select("_i", "_n", F.col("_k.k").alias("k"), F.col("_k.q").alias("q"),
                                                               F.get("_m", F.col("_k.k") * 2).alias("a"), F.get("_m", F.col("_k.k") * 2 + 1).alias("b"))
    # len(columns) * len(qs) rows, by construction
    rows = long.join(F.broadcast(s), F.col("i") == F.col("_i"))
    side = F.when(F.col("v") < F.col("a"), F.lit(-1)).when(F.col("v") > F.col("b"), F.lit(1)).otherwise(F.lit(0))
    counts = rows.groupBy("i", "k", "q", "_n", side.alias("side"), F.when(side == 0, F.col("v")).alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    upto = Window.partitionBy("i", "k").orderBy("side", "v").rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("cum", F.sum("c").over(upto))
    at = (F.col("_n") - F.lit(1)) * F.col("q")

    def order_statistic(r: Column) -> Column:
        """The value of 0-based rank r; rounding of ranks may put it one row beside the bracket."""
        here = (F.col("cum") > r) & (F.col("cum") - F.col("c") <= r)
        beyond = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
        value = (F.when(F.col("side") == 0, F.col("v")).when((F.col("side") < 0) & (F.col("cum") - F.lit(1) == r), F.col("most"))
                 .when((F.col("side") > 0) & (F.col("cum") - F.col("c") == r), F.col("least")).otherwise(beyond))
        return F.max(F.when(here, value))

    per = c.groupBy("i", "k").agg(order_statistic(F.floor(at)).alias("lo"), order_statistic(F.ceil(at)).alias("hi"), F.max(at - F.floor(at)).alias("f"))
    value = F.when(F.col("f") == 0, F.col("lo")).otherwise((F.lit(1.0) - F.col("f")) * F.col("lo") + F.col("f") * F.col("hi"))
    # len(columns) * len(qs) rows
    pick = lambda i: F.array(*[F.max(F.when((F.col("i") == i) & (F.col("k") == j), value)) for j in range(len(qs))])
    return per.select(F.struct(*[pick(i).alias(f"q{i}") for i in range(len(columns))])).scalar()
