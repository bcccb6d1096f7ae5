"""Distance and geometry column builders (M-03, M-04, M-09, R-01, F-03, F-04)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.config import EARTH_RADIUS_KM, EQ_DEPTH_SCALE_KM, EQ_MIN_DIST_KM, EQ_RECENCY_HOURS


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """M-03: great-circle distance in km (R = 6371)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = F.radians(_c(lat2) - _c(lat1))
    dlon = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def depth_factor(depth_km) -> Column:
    """1 / (1 + depth / 70), missing depth -> 0 (code)."""
    return F.lit(1.0) / (F.lit(1.0) + F.coalesce(_c(depth_km), F.lit(0.0)) / F.lit(EQ_DEPTH_SCALE_KM))


def depth_factor_spec(depth_km) -> Column:
    """SP-02: piecewise 1.0 / 0.7 / 0.4 (spec); missing depth -> 1.0."""
    from tidewatch.config import EQ_SPEC_DEPTH_ELSE, EQ_SPEC_DEPTH_STEPS
    d = F.coalesce(_c(depth_km), F.lit(0.0))
    out = None
    for limit, factor in EQ_SPEC_DEPTH_STEPS:
        out = F.when(d <= limit, F.lit(factor)) if out is None else out.when(d <= limit, F.lit(factor))
    return out.otherwise(F.lit(EQ_SPEC_DEPTH_ELSE))


def quake_source_factor(magnitude, depth_km, age_hours, depth=depth_factor) -> Column:
    """The per-event part of M-09: mag (missing -> 0) * depth factor * exp(-max(age, 0) / 168)."""
    mag = F.coalesce(_c(magnitude), F.lit(0.0))
    recency = F.exp(-F.greatest(_c(age_hours), F.lit(0.0)) / F.lit(EQ_RECENCY_HOURS))
    return mag * depth(depth_km) * recency


def distance_attenuation(dist_km) -> Column:
    """The per-pair part of M-09: log1p(max(d, 1e-3)), always > 0."""
    return F.log1p(F.greatest(_c(dist_km), F.lit(EQ_MIN_DIST_KM)))


def in_bbox(lat, lon, min_lat, max_lat, min_lon, max_lon) -> Column:
    """F-03: inclusive bounding box; missing coordinates -> false."""
    inside = _c(lat).between(min_lat, max_lat) & _c(lon).between(min_lon, max_lon)
    return F.coalesce(inside, F.lit(False))


def valid_coordinate(lat, lon, eps: float = 1e-9) -> Column:
    """F-04: present, not (0, 0) within eps, and in range."""
    la, lo = _c(lat), _c(lon)
    ok = (la.isNotNull() & lo.isNotNull()
          & ~((F.abs(la) < eps) & (F.abs(lo) < eps))
          & la.between(-90.0, 90.0) & lo.between(-180.0, 180.0))
    return F.coalesce(ok, F.lit(False))


def ring_centroid(rings) -> Column:
    """R-01: mean of the first ring's vertices (closing vertex counted again).

    ``rings`` is array<array<array<double>>> ([ring][vertex][lon, lat]).
    Returns struct<lon, lat>.
    """
    ring = F.element_at(_c(rings), 1)
    n = F.size(ring)
    sum_lon = F.aggregate(ring, F.lit(0.0), lambda acc, v: acc + F.element_at(v, 1))
    sum_lat = F.aggregate(ring, F.lit(0.0), lambda acc, v: acc + F.element_at(v, 2))
    return F.when(n > 0, F.struct((sum_lon / n).alias("lon"), (sum_lat / n).alias("lat")))
