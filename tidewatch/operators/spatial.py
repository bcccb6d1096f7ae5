"""Spatial operators: radius join, distance-kernel aggregation, area hazard.

Two strategies, both exact:

* ``radius_join`` (J-13) -- pairs within ``r`` km.  Points are put on a
  lat/lon grid whose cells are at least ``r`` wide at their own latitude, the right
  side is replicated to its 3x3 neighbour cells, and the sides are equi-joined on
  the cell (a normal shuffle or broadcast hash join chosen by Catalyst/AQE), then
  filtered by the exact haversine distance.  Candidates per point are bounded
  by the local density, not by the table size.  ``nearest_join`` (J-19) widens it
  for the rows that have found nothing yet.

* ``kernel_aggregate`` (J-11 / J-12 + A-04 / A-05 / A-16) -- the decay-weighted
  mean and the earthquake maximum sum over *every* station / event (the
  weight ``exp(-d / 25 km)`` never reaches zero), so the work is inherently
  areas x locations.  Points are reduced to one row per location first.  Areas
  and locations are then dealt to a grid of (area bucket, location bucket)
  keys and equi-joined on it, at every size: each task meets one bucket of
  either side, and a map-side partial aggregate folds the pairs, so the next
  shuffle carries one row per area and grid key.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.geo import haversine_km

KM_PER_RAD = C.EARTH_RADIUS_KM
#: Keys of the (area bucket, location bucket) grid of ``kernel_pairs`` per shuffle partition of the session.
KEYS_PER_PARTITION = 4
#: Parts that the left rows of a cell of ``radius_join`` are dealt to.
CELL_SALTS = 4


def _grid(r_km: float, lat: Column, lon: Column, row_offset: Column | None = None) -> tuple[Column, Column, Column]:
    """(row, cell in the row, cells of the row) of a point, on rows at least ``r_km`` high.

    With ``row_offset`` the cell is that of the point's longitude in a row nearby.  A
    row's cells are so wide that two points within ``r_km``, one of them in the row and
    the other in it or next to it, are at most one cell apart: sin(dlon / 2) <= sin(r / 2R) /
    cos(lat), by the haversine formula with both cosines at least that of the row's and its
    neighbours' highest latitude.  Cells go round: the last one touches the first,
    and near a pole a row is one cell.
    """
    high = math.degrees(r_km / KM_PER_RAD) * (1 + 1e-9)
    row = F.floor(lat / F.lit(high)).cast("long")
    if row_offset is not None:
        row = row + row_offset
    top = (F.greatest(F.abs(row - F.lit(1)), F.abs(row + F.lit(2))) * F.lit(high))
    cos = F.when(top < 89.999, F.cos(F.radians(top)))
    x = F.try_divide(F.lit(math.sin(min(r_km / (2 * KM_PER_RAD), math.pi / 2))), cos)
    wide = F.when((x < 1.0) & F.lit(high < 60.0), F.degrees(F.lit(2.0) * F.asin(x)) * F.lit(1 + 1e-9))
    cells = F.greatest(F.coalesce(F.floor(F.lit(360.0) / wide), F.lit(1)), F.lit(1)).cast("long")
    at = F.least(F.floor(F.pmod(lon + F.lit(180.0), F.lit(360.0)) / (F.lit(360.0) / cells)).cast("long"), cells - F.lit(1))
    return row, at, cells


def radius_join(left: DataFrame, right: DataFrame, r_km: float, left_coords=("latitude", "longitude"), right_coords=("lat", "lon"),
                dist_col: str = "dist_km", salts: int = CELL_SALTS) -> DataFrame:
    """J-13: all (left, right) pairs with haversine distance <= r_km (inclusive).

    Any latitude, the antimeridian and the poles included.  The right side is
    repeated for its neighbour cells and for ``salts`` parts of each cell, over which the
    left rows of a dense cell are dealt.  Rows with null coordinates never match.
    """
    (la, lo), (ra, ro) = left_coords, right_coords
    row, cell, _ = _grid(r_km, F.col(la), F.col(lo))
    lcell = left.filter(F.col(la).isNotNull() & F.col(lo).isNotNull()).withColumns({
        "_cy": row, "_cx": cell, "_cs": F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")})
    offs = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    near = right.filter(F.col(ra).isNotNull() & F.col(ro).isNotNull()).withColumn("_coff", F.explode(offs))
    row, cell, cells = _grid(r_km, F.col(ra), F.col(ro), F.col("_coff"))
    near = near.withColumns({"_cy": row, "_cat": cell, "_ccells": cells}).withColumn("_cx", F.explode(F.array_distinct(F.array(
        *[F.pmod(F.col("_cat") + F.lit(i), F.col("_ccells")) for i in (-1, 0, 1)])))).drop("_coff", "_cat", "_ccells")
    rcell = near.withColumn("_cs", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    j = lcell.join(rcell, ["_cy", "_cx", "_cs"], "inner")
    d = haversine_km(F.col(la), F.col(lo), F.col(ra), F.col(ro))
    return j.withColumn(dist_col, d).filter(F.col(dist_col) <= r_km).drop("_cy", "_cx", "_cs")


def nearest_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, first_km: float = 10.0,
                 left_coords=("latitude", "longitude"), right_coords=("lat", "lon")) -> DataFrame:
    """J-19: left key, key and distance of the nearest right row (of equal ones the smallest key) of every left row.

    Rings that widen: a neighbour found within a radius is the nearest, as all
    nearer ones lie within it too; only rows that found none go on with four
    times the radius, until it reaches round the globe.  Each round's rows without an
    answer are written, so a round never repeats the one before.  Rows without
    coordinates, and all rows if the right side is empty, have nulls.  ``left_key``
    is unique.  A row meets the right rows within four times its nearest distance,
    so the right side should be a dimension (areas, stations).
    """
    from tidewatch.session import stage_checkpoint
    (la, lo), (ra, ro) = left_coords, right_coords
    points = right.select(F.col(right_key).alias("_right_key"), F.col(ra).alias("_ra"), F.col(ro).alias("_ro")).filter("_ra IS NOT NULL AND _ro IS NOT NULL")
    rest = left.select(F.col(left_key).alias("_left_key"), F.col(la).alias("_la"), F.col(lo).alias("_lo"))
    found, r = None, float(first_km)
    while True:
        pairs = radius_join(rest, points, r, ("_la", "_lo"), ("_ra", "_ro"), "_d")
        best = pairs.groupBy("_left_key").agg(F.min(F.struct("_d", "_right_key")).alias("_b"))
        done = stage_checkpoint(rest.join(best, "_left_key", "left").select("_left_key", "_la", "_lo", "_b"), "nearest")
        hit = done.filter(F.col("_b").isNotNull())
        found = hit if found is None else found.unionByName(hit)
        rest = done.filter(F.col("_b").isNull()).drop("_b")
        if r >= math.pi * KM_PER_RAD or rest.filter("_la IS NOT NULL AND _lo IS NOT NULL").isEmpty():
            break
        r = min(4 * r, math.pi * KM_PER_RAD * (1 + 1e-9))
    out = found.unionByName(rest, allowMissingColumns=True)
    return out.select(F.col("_left_key").alias(left_key), F.col("_b._right_key").alias(right_key), F.col("_b._d").alias("dist_km"))


def kernel_pairs(areas: DataFrame, points: DataFrame, area_key: str, area_coords=("latitude", "longitude"),
                 point_coords=("lat", "lon"), area_buckets: int | None = None, point_buckets: int | None = None) -> DataFrame:
    """Every (area, point) pair with its distance ``_d``, dealt to a grid of bucket keys; to be folded at once.

    The grid has a few keys for every shuffle partition of the session, so it grows with the cluster.
    """
    keys = KEYS_PER_PARTITION * int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    point_buckets = point_buckets or math.ceil(math.sqrt(2 * keys))
    area_buckets = area_buckets or math.ceil(keys / point_buckets)
    la, lo = area_coords
    pa, po = point_coords
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = areas.select(area_key, F.col(la).alias("_alat"), F.col(lo).alias("_alon")).withColumn(
        "_ab", F.pmod(F.xxhash64(area_key), F.lit(area_buckets)).cast("int")).withColumn("_pb", every(point_buckets))
    p = points.withColumn("_pb", F.pmod(F.xxhash64(pa, po), F.lit(point_buckets)).cast("int")).withColumn("_ab", every(area_buckets))
    return p.join(a, ["_ab", "_pb"]).withColumn("_d", haversine_km(F.col("_alat"), F.col("_alon"), F.col(pa), F.col(po)))


def kernel_aggregate(areas: DataFrame, points: DataFrame, area_key: str, aggs_fn,
                     area_coords=("latitude", "longitude"), point_coords=("lat", "lon"),
                     area_buckets: int | None = None, point_buckets: int | None = None) -> DataFrame:
    """Aggregate a function of (area, point, distance) over every point, per area.

    ``points`` has one row per location.  ``aggs_fn(dist_col: Column) ->
    list[Column]`` builds the aggregate columns.  Returns one row per area if
    there is a point at all.
    """
    pairs = kernel_pairs(areas, points, area_key, area_coords, point_coords, area_buckets, point_buckets)
    return pairs.groupBy(area_key).agg(*aggs_fn(F.col("_d")))


def area_flood_hazard(areas: DataFrame, stations: DataFrame, global_alert: Column,
                      lambda_km: float = C.LAMBDA_KM, override_km: float = C.OVERRIDE_KM,
                      area_key: str = "area_id") -> DataFrame:
    """D-15: max(distance-weighted mean, local max within override_km, global alert).

    ``stations``: lat, lon, flood_hazard_final.  Areas without coordinates are
    dropped (as in the reference); the rest keep null station columns when
    there are no stations.
    """
    def aggs(dist: Column):
        w = F.exp(-dist / F.lit(float(lambda_km)))
        near = dist <= F.lit(float(override_km))
        return [
            F.sum(w * F.col("_h")).alias("_swh"),
            F.sum(w * F.col("_n")).alias("_sw"),
            F.max(F.when(near, F.col("_top"))).alias("flood_hazard_local_max"),
            F.sum("_n").alias("supporting_station_count"),
            F.coalesce(F.sum(F.when(near, F.col("_n"))), F.lit(0)).alias("nearby_station_count"),
        ]

    located = areas.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    # stations at one place weigh alike: their sum, largest and number are all the formula needs
    st = stations.groupBy("lat", "lon").agg(F.sum("flood_hazard_final").alias("_h"), F.max("flood_hazard_final").alias("_top"),
                                            F.count(F.lit(1)).alias("_n"))
    k = kernel_aggregate(located, st, area_key, aggs)
    out = located.join(k, area_key, "left")
    return (out.withColumn("flood_hazard_weighted", F.try_divide(F.col("_swh"), F.col("_sw")))
               .withColumn("nws_global_alert_score", global_alert.cast("double"))
               .withColumn("flood_hazard_muni", F.greatest("flood_hazard_weighted", "flood_hazard_local_max",
                                                           "nws_global_alert_score"))
               .withColumn("supporting_station_count", F.coalesce("supporting_station_count", F.lit(0)))
               .withColumn("nearby_station_count", F.coalesce("nearby_station_count", F.lit(0)))
               .drop("_swh", "_sw"))


def bounded_flood_mean(areas: DataFrame, stations: DataFrame, lambda_km: float = C.LAMBDA_KM, cell_km: float = 1.0, near_km: float = C.OVERRIDE_KM,
                       area_key: str = "area_id") -> DataFrame:
    """The distance-weighted mean of D-15 with fewer pairs, and proven bounds of the exact value.

    Stations are summed per cell of ``cell_km``.  Cells near an area (and with them
    every station within ``near_km``) are opened and their stations weighed one by
    one; of a cell farther away only the sum is used, with the distance of its
    middle.  No station is farther than rho from the middle of its cell, so its
    weight exp(-d / lambda) is off by a factor of at most exp(rho / lambda), and
    with it the far sums: ``mean_lo`` and ``mean_hi`` take both at their worst.
    The exact mode is ``area_flood_hazard``.  ``pairs`` counts the pairs weighed.
    ``stations``: lat, lon, flood_hazard_final (not negative).
    """
    step = cell_km / (KM_PER_RAD * math.pi / 180)  # degrees of latitude
    band = F.floor(F.col("lat") / F.lit(step))
    wide = F.lit(step) / F.greatest(F.cos(F.radians((band + F.lit(0.5)) * F.lit(step))), F.lit(1e-3))
    st = stations.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumns({
        "_cell": F.concat_ws(":", band, F.floor(F.col("lon") / wide)),
        "_mlat": (band + F.lit(0.5)) * F.lit(step), "_mlon": (F.floor(F.col("lon") / wide) + F.lit(0.5)) * wide})
    own = haversine_km(F.col("lat"), F.col("lon"), F.col("_mlat"), F.col("_mlon"))
    places = st.groupBy("_cell", "_mlat", "_mlon", "lat", "lon").agg(F.sum("flood_hazard_final").alias("h"), F.count(F.lit(1)).alias("n"), F.max(own).alias("r"))
    cells = places.groupBy("_cell", "_mlat", "_mlon").agg(F.sum("h").alias("h"), F.sum("n").alias("n"), F.max("r").alias("rho"))
    located = areas.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(area_key, "latitude", "longitude")
    pairs = kernel_pairs(located, cells, area_key, point_coords=("_mlat", "_mlon"))
    opened = F.col("_d") <= F.lit(near_km) + F.col("rho")  # whatever the cell holds within near_km
    w, lam = F.exp(-F.col("_d") / F.lit(float(lambda_km))), F.lit(float(lambda_km))
    up = F.exp(F.col("rho") / lam)
    far = pairs.filter(~opened).groupBy(area_key).agg(
        F.sum(w * F.col("h")).alias("fh"), F.sum(w * F.col("n")).alias("fw"), F.sum(w * F.col("h") * up).alias("fh_up"), F.sum(w * F.col("h") / up).alias("fh_lo"),
        F.sum(w * F.col("n") * up).alias("fw_up"), F.sum(w * F.col("n") / up).alias("fw_lo"), F.count(F.lit(1)).alias("n_far"))
    inside = pairs.filter(opened).select(area_key, "_alat", "_alon", "_cell").join(places.select("_cell", "lat", "lon", F.col("h").alias("ph"), F.col("n").alias("pn")), "_cell")
    near_w = F.exp(-haversine_km(F.col("_alat"), F.col("_alon"), F.col("lat"), F.col("lon")) / lam)
    near = inside.groupBy(area_key).agg(F.sum(near_w * F.col("ph")).alias("nh"), F.sum(near_w * F.col("pn")).alias("nw"), F.count(F.lit(1)).alias("n_near"))
    j = located.select(area_key).join(far, area_key, "left").join(near, area_key, "left").na.fill(0)
    mean = lambda h, n: F.try_divide(F.col("nh") + F.col(h), F.col("nw") + F.col(n))
    return j.select(area_key, mean("fh", "fw").alias("flood_hazard_weighted"), mean("fh_lo", "fw_up").alias("mean_lo"), mean("fh_up", "fw_lo").alias("mean_hi"),
                    (F.col("n_near") + F.col("n_far")).alias("pairs"))


def area_quake_raw(areas: DataFrame, quakes: DataFrame, as_of: Column, area_key: str = "area_id",
                   depth_fn=None) -> DataFrame:
    """D-16 raw part: max over all events of the M-09 intensity, per area.

    Intensity = source factor / attenuation(distance), and the attenuation is
    positive, so at one location only the largest source factor can be the
    maximum.  Events are therefore reduced to (location, max factor) first --
    a partial-aggregating group-by, so a location hit by a third of all
    events still ships one row per map task -- and the per-event expressions
    (JSON fields, ages) are evaluated once per event instead of once per
    (event, area) pair inside the nested loop.  Events without a position or
    time give a null intensity, which ``max`` skips; they are dropped here.
    """
    from tidewatch.functions.geo import depth_factor, distance_attenuation, quake_source_factor
    from tidewatch.functions.timefn import hours_between
    depth_fn = depth_fn or depth_factor
    f = quake_source_factor("magnitude", "depth_km", hours_between(as_of, F.col("time_utc")), depth=depth_fn)
    q = (quakes.select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), f.alias("_f"))
               .groupBy("lat", "lon").agg(F.max("_f").alias("_f"))
               .filter(F.col("_f").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()))

    def aggs(dist: Column):
        return [F.max(F.col("_f") / distance_attenuation(dist)).alias("earthquake_raw")]

    located = areas.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return kernel_aggregate(located, q, area_key, aggs)
