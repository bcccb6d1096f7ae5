"""Null-aware numeric column builders (M-01 .. M-10, D-01)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def clip(x, lo=None, hi=None) -> Column:
    """M-01: clip to [lo, hi]; a missing value stays missing.

    ``greatest``/``least`` skip nulls, so a bare ``greatest(0, null)`` would
    turn a missing value into 0; the ``when`` guard keeps it null.
    """
    x = _c(x)
    out = x
    if lo is not None:
        out = F.greatest(out, _lit(lo))
    if hi is not None:
        out = F.least(out, _lit(hi))
    return F.when(x.isNotNull(), out)


def safe_div(num, den) -> Column:
    """M-02: division with a zero or missing denominator -> null."""
    return F.try_divide(_c(num), _c(den))


def normalize_linear(x, lo, hi) -> Column:
    """D-01: (x - lo) / (hi - lo) clipped to [0, 1] x 100; null when x is null or hi <= lo."""
    x, lo_c, hi_c = _c(x), _lit(lo), _lit(hi)
    scaled = clip((x - lo_c) / (hi_c - lo_c), 0.0, 1.0) * F.lit(100.0)
    return F.when(x.isNotNull() & (hi_c > lo_c), scaled)


def nan_mean(*cols) -> Column:
    """M-05: mean of the non-null arguments; null when all are null."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return F.when(n > 0, total / n)


def non_null_fraction(*cols) -> Column:
    """M-07: fraction of the listed columns that are present."""
    cs = [_c(c) for c in cols]
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("double") for c in cs])
    return n / F.lit(float(len(cs)))


def weighted_sum(pairs, fill_missing: float | None = None) -> Column:
    """Sum of w * x over (column, weight) pairs.

    ``fill_missing=None`` propagates nulls (vulnerability composite);
    a number replaces missing inputs first (baseline risk index).
    """
    terms = []
    for col, w in pairs:
        c = _c(col)
        if fill_missing is not None:
            c = F.coalesce(c, F.lit(float(fill_missing)))
        terms.append(F.lit(float(w)) * c)
    return reduce(lambda a, b: a + b, terms)


def round_half_even(x, digits: int = 1) -> Column:
    """M-08: Python/numpy style rounding (half to even)."""
    return F.bround(_c(x), digits)


def bounds_predicate(bounds: dict[str, tuple[float | None, float | None]]) -> Column:
    """F-10: inclusive range predicate over several columns, each bound optional.

    ``{"magnitude": (2.5, None), "longitude": (None, -65.5)}`` -> magnitude >= 2.5
    AND longitude <= -65.5.  A missing value fails any bound that applies; no
    bounds at all -> true.
    """
    preds = []
    for col, (lo, hi) in bounds.items():
        if lo is not None:
            preds.append(F.col(col) >= F.lit(lo))
        if hi is not None:
            preds.append(F.col(col) <= F.lit(hi))
    out = F.lit(True)
    for p in preds:
        out = out & p
    return F.coalesce(out, F.lit(False))
