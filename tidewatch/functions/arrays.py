"""Array helpers (T-09, T-10, R-02, R-03)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def or_fallback(arr, fallback) -> Column:
    """T-09: empty or missing array -> single-element array of ``fallback``."""
    a = _c(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) > 0, a).otherwise(F.array(_c(fallback)))


def join_list(arr, sep: str = ",") -> Column:
    """T-10: array -> text."""
    return F.array_join(_c(arr), sep)


def list_or_scalar(variant_col) -> Column:
    """R-03: a variant holding either a list of strings or one scalar -> array<string>."""
    v = _c(variant_col)
    as_list = F.try_variant_get(v, "$", "array<string>")
    as_scalar = F.try_variant_get(v, "$", "string")
    return F.when(v.isNull(), F.lit(None).cast("array<string>")).otherwise(
        F.coalesce(as_list, F.when(as_scalar.isNotNull(), F.array(as_scalar))))


def select_existing(df, cols):
    """F-01: the listed columns that exist in ``df``, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])
