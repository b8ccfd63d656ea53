"""Epoch milliseconds, timestamps and local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the plant's time zone.
PLANT_ZONE = "America/New_York"
HOUR_MS = 3_600_000


def exact(ms: Column | str) -> Column:
    """Timestamp that keeps the milliseconds."""
    return F.timestamp_millis(_c(ms))


def to_second(ms: Column | str) -> Column:
    """Milliseconds cut to the whole second, toward zero as integer division does."""
    ms = _c(ms)
    return ms - ms % 1000


def truncated(ms: Column | str) -> Column:
    """Timestamp without its sub-second part."""
    return F.timestamp_millis(to_second(ms))


def _c(ms: Column | str) -> Column:
    return F.col(ms) if isinstance(ms, str) else ms


def local_time(ts: Column, zone: str = PLANT_ZONE) -> Column:
    """Wall-clock time in ``zone``, a timestamp without time zone."""
    return F.from_utc_timestamp(ts, zone).cast("timestamp_ntz")


def local_date(ts: Column, zone: str = PLANT_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def local_iso(ts: Column, zone: str = PLANT_ZONE) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd'T'HH:mm:ss")


def hours(ms: Column | str) -> Column:
    return _c(ms) / HOUR_MS
