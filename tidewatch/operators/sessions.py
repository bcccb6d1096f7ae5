"""Sessions of points in time: islands with less than a gap between neighbours (ST-06)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_sessions(sessions: DataFrame, keys: list[str], gap_hours: float) -> DataFrame:
    """Sessions (keys, ``first``, ``last``, ``n``) merged wherever less than the gap lies between two.

    Points are sessions of their own with first = last.  Sessions that begin in one
    bucket of the gap's length overlap or lie less than a gap apart, so they are
    folded by a partial aggregate first; the window then holds at most one row per
    key and bucket, however many points a key has.
    """
    gap = int(gap_hours * 3_600_000_000)
    s = sessions.groupBy(*keys, F.floor(F.col("first") / F.lit(gap)).alias("_b")).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    line = Window.partitionBy(*keys).orderBy("first")
    reach = F.max("last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("_new", (reach.isNull() | (F.col("first") - reach >= F.lit(gap))).cast("long"))
    s = s.withColumn("_id", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*keys, "_id").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("_id")
