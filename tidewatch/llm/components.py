"""Distributed connected components by alternating large-star and small-star steps.

Each step is a partial-aggregating minimum per node and one equi-join back to
the edges.  A hub with a third of all edges ships one row per map task in the
aggregate; the minima are written before the join, so that both of its sides
are plain scans and the skew-join rule can split the hub's edge rows.  No component
is gathered anywhere.  The edge table of every round is written to the checkpoint
folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import discard, materialise


def _star(edges: DataFrame, both_ways: bool, name: str) -> tuple[DataFrame, DataFrame]:
    """Large star (neighbours above u move to u's minimum) or small star (those below); with it the table of minima it reads."""
    if both_ways:
        e = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = materialise(e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-low")
    if both_ways:
        moved = e.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the minimum itself keeps its edge from u; the others hang under the minimum
        moved = (e.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                         F.col("m").alias("v")))
    return moved.filter("u <> v").distinct(), low


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v); component is its smallest node.

    Self links, repeated links and rows with a null end are ignored; an empty
    table gives no rows.
    """
    e = materialise(edges.select("u", "v").filter("u <> v").distinct(), name)
    before = None
    while True:
        moved, low = _star(e, True, name)
        step = materialise(moved, name)
        discard(low)
        moved, low = _star(step, False, name)
        nxt = materialise(moved, name)
        discard(low)
        discard(step)
        sums = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(e)
        e = nxt
        if sums["n"] == 0 or (sums["n"], sums["h"]) == before:
            break
        before = (sums["n"], sums["h"])
    # now every edge is (node, smallest)
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
