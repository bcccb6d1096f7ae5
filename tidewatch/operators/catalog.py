"""Station catalogue operators: first-seen dedupe, coordinate repair, row guards.

A catalogue arrives as a list of station entries, possibly repeated across
documents.  Entries outside the bounding box or without a position are
dropped, then the first entry per station id stays.  The metadata step after
the selection repairs coordinates that fail the validity test from a lookup
keyed by station id.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.geo import in_bbox, valid_coordinate


def dedupe_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """A-12: one row per key, the first seen (min order_col) wins.

    An aggregate of min(struct(order, row)) rather than a window: it combines
    map-side, so a key repeated in a third of all rows still ships one row per
    map task.
    """
    cols = [c for c in df.columns if c not in (key, order_col)]
    agg = df.groupBy(key).agg(F.min(F.struct(F.col(order_col), *[F.col(c) for c in cols])).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in [order_col] + cols])


def with_coordinate_fallback(df: DataFrame, lookup: DataFrame, key: str,
                             lat: str = "lat", lon: str = "lon") -> DataFrame:
    """F-04 + F-05: keep valid coordinates; otherwise take the lookup's
    (``fb_lat``, ``fb_lon``) for the same key; drop rows still invalid.

    ``coord_source`` says which side was used.  The lookup is a station
    dimension (one row per id); it is de-duplicated on the key so the left
    join cannot fan out, and the join strategy is left to the optimizer
    (broadcast when its measured size is under the threshold).
    """
    lk = lookup.dropDuplicates([key])
    j = df.join(lk, key, "left")
    ok = valid_coordinate(F.col(lat), F.col(lon))
    fb_ok = valid_coordinate(F.col("fb_lat"), F.col("fb_lon"))
    j = j.withColumns({
        "coord_source": F.when(ok, F.lit("feed")).when(fb_ok, F.lit("fallback")),
        lat: F.when(ok, F.col(lat)).when(fb_ok, F.col("fb_lat")),
        lon: F.when(ok, F.col(lon)).when(fb_ok, F.col("fb_lon")),
    })
    return j.filter(F.col("coord_source").isNotNull()).drop("fb_lat", "fb_lon")


def station_selection(catalog: DataFrame, requested: DataFrame, excluded: DataFrame,
                      key: str = "station_id") -> DataFrame:
    """J-14: the requested ids that the catalogue has, else the whole catalogue; excluded ids are
    taken out last.  Each side has one row per id; ``selection_mode`` says which list was used."""
    hit = catalog.join(requested, key, "left_semi")
    any_hit = hit.select(F.count(F.lit(1)) > 0).scalar()
    chosen = hit.withColumn("selection_mode", F.lit("requested")).unionByName(
        catalog.filter(~any_hit).withColumn("selection_mode", F.lit("catalog")))
    return chosen.join(excluded, key, "left_anti")


def sorted_ids(ids: DataFrame, key: str = "station_id", cap: int | None = None) -> DataFrame:
    """L-04: distinct ids in text order; ``cap`` guards what is downloaded and is off by default."""
    out = ids.select(key).distinct().orderBy(F.col(key).cast("string"))
    return out if cap is None else out.limit(cap)


def in_catalog_box(df: DataFrame, bbox: tuple[float, float, float, float], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """F-03: entries inside the inclusive box; entries without a position are outside."""
    return df.filter(in_bbox(F.col(lat), F.col(lon), *bbox))


def on_tidal_datum(df: DataFrame, tidal: str = "tidal") -> DataFrame:
    """F-06: a missing flag counts as false."""
    return df.filter(F.coalesce(F.col(tidal), F.lit(False)))


def assert_rows(df: DataFrame, min_rows: int = 1, max_rows: int | None = None, what: str = "rows") -> DataFrame:
    """F-15: fail the job when the row count is below ``min_rows`` or above
    ``max_rows``; otherwise return ``df`` unchanged.

    The count is a scalar subquery evaluated inside the plan (``raise_error``),
    so nothing is collected to the driver and the check runs on the cluster.
    """
    n = F.count(F.lit(1))
    bad = n < F.lit(min_rows)
    msg = F.concat(F.lit(f"{what}: expected at least {min_rows}, got "), n.cast("string"))
    if max_rows is not None:
        bad_hi = n > F.lit(max_rows)
        msg = F.when(bad_hi, F.concat(F.lit(f"{what}: more than {max_rows}: "), n.cast("string"))).otherwise(msg)
        bad = bad | bad_hi
    # one scalar subquery: the count is taken once, and the subquery itself raises
    ok: Column = df.select(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True))).scalar()
    return df.filter(ok)
