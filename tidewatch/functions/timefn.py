"""Time column builders (D-DT1 .. D-DT5)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def as_utc(x) -> Column:
    """timestamp_ntz (wall clock UTC) -> timestamp; identity on timestamps."""
    return _c(x).cast("timestamp")


def epoch_ms_to_ts(x) -> Column:
    """D-DT1: epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(x).cast("long"))


def parse_ts(x) -> Column:
    """D-DT2: ISO-8601 text (with or without offset) -> timestamp, failure -> null."""
    return F.try_to_timestamp(_c(x))


def hours_between(later, earlier) -> Column:
    """Signed hours from ``earlier`` to ``later`` (micro-second exact).

    Works for timestamp and timestamp_ntz inputs alike, via the UTC cast.
    """
    return (F.unix_micros(as_utc(later)) - F.unix_micros(as_utc(earlier))) / F.lit(3.6e9)


def minutes_between(later, earlier) -> Column:
    """Signed minutes from ``earlier`` to ``later`` (one division, micro-second exact)."""
    return (F.unix_micros(as_utc(later)) - F.unix_micros(as_utc(earlier))) / F.lit(6e7)


def hours_between_floor(later, earlier, floor: float) -> Column:
    """D-DT4: hours between, floored (1e-6 for rates, 0 for ages)."""
    return F.greatest(hours_between(later, earlier), F.lit(float(floor)))


def ts_to_epoch_ms(x) -> Column:
    """D-DT5: timestamp -> epoch milliseconds."""
    return F.unix_millis(as_utc(x))
