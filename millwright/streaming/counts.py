"""Windowed and session counts of a sample stream, emitted once when a window closes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.operators.periods import GRACE_MS, SESSION_GAP_MS, TUMBLING_MS


def _ms(width: int) -> str:
    return f"{width} milliseconds"


def with_event_time(samples: DataFrame, grace_ms: int = GRACE_MS) -> DataFrame:
    """Samples with event time ``ts``; rows later than the grace behind the newest are dropped.

    The watermark follows the newest row of the whole query, not of each partition. Where machines
    lag behind one another, give a grace as long as the longest lag.
    """
    return samples.withColumn("ts", F.timestamp_millis("timestamp")).withWatermark("ts", _ms(grace_ms))


def _named(counts: DataFrame, end) -> DataFrame:
    return counts.select(
        "machine_id",
        F.unix_millis("w.start").alias("windowStart"),
        end.alias("windowEnd"),
        "count",
    )


def window_counts(
    samples: DataFrame,
    width_ms: int = TUMBLING_MS,
    slide_ms: int | None = None,
    grace_ms: int = GRACE_MS,
) -> DataFrame:
    """Counts per machine and tumbling window, or hopping window if ``slide_ms`` is given."""
    slide = _ms(slide_ms or width_ms)
    window = F.window("ts", _ms(width_ms), slide).alias("w")
    counts = with_event_time(samples, grace_ms).groupBy("machine_id", window).agg(F.count("*").alias("count"))
    return _named(counts, F.unix_millis("w.end"))


def session_counts(samples: DataFrame, gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> DataFrame:
    """Counts per machine and session; windowEnd is the time of the session's last sample."""
    session = F.session_window("ts", _ms(gap_ms)).alias("w")
    counts = with_event_time(samples, grace_ms).groupBy("machine_id", session).agg(F.count("*").alias("count"))
    return _named(counts, F.unix_millis("w.end") - gap_ms)
