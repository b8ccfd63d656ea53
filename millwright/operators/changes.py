"""State changes and runs: dedup, durations, spans, executions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.text import present
from millwright.operators.ordered import (
    MARKED,
    SLICE,
    STREAM_ORDER,
    TIME_ORDER,
    over_slices,
    slice_by_offset,
    slice_by_time,
    unsliced,
)
from millwright.operators.periods import BUCKET_MS, activity_periods


def execution_events(samples: DataFrame) -> DataFrame:
    """One event per sample that carries an execution state."""
    return samples.filter(present("execution")).select(
        "machine_id", "execution", "timestamp", "offset", "partition"
    )


def dedup_consecutive(df: DataFrame, value: str, rows: int | None = None) -> DataFrame:
    """Drop rows repeating the machine's last non-null value, in stream order; null values pass."""
    return unsliced(changes_only(slice_by_offset(df, rows), value))


def changes_only(sliced: DataFrame, value: str) -> DataFrame:
    compared = over_slices(sliced, STREAM_ORDER, carry_before={"_last": F.col(value)})
    kept = F.col(value).isNull() | F.col("_last").isNull() | (F.col(value) != F.col("_last"))
    return compared.filter(kept).drop("_last")


def execution_run_duration(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Completed runs of one state in stream order; the open run is left out."""
    changes = changes_only(slice_by_offset(execution_events(samples), rows), "execution")
    return (
        over_slices(changes, STREAM_ORDER, lead={"end": F.col("timestamp")})
        .filter(F.col("end").isNotNull())
        .select(
            "machine_id",
            "execution",
            F.col("timestamp").alias("start"),
            "end",
            "offset",
            "partition",
            (F.col("end") - F.col("timestamp")).alias("duration"),
        )
    )


def spans(events: DataFrame, rows: int | None = None) -> DataFrame:
    """Each event with ``stop``, the time of the machine's next event; null for the last."""
    return unsliced(
        over_slices(slice_by_time(events, rows=rows), TIME_ORDER, lead={"stop": F.col("timestamp")})
    )


def second_spans(events: DataFrame, rows: int | None = None) -> DataFrame:
    """Closed spans with start and stop cut to whole seconds and their duration, all in ms."""
    return (
        spans(events, rows)
        .filter(F.col("stop").isNotNull())
        .withColumn("start", clock.to_second("timestamp"))
        .withColumn("stop", clock.to_second("stop"))
        .withColumn("duration", F.col("stop") - F.col("start"))
    )


def active_longer_than(spans_: DataFrame, threshold_ms: int) -> DataFrame:
    return spans_.filter((F.col("execution") == "ACTIVE") & (F.col("duration") > threshold_ms))


def executions(samples: DataFrame, width_ms: int = BUCKET_MS, rows: int | None = None) -> DataFrame:
    """State runs clipped to activity periods: machine_id, start, end, duration, execution, r."""
    return runs_in_periods(execution_events(samples), activity_periods(samples, width_ms), rows)


def in_periods(events: DataFrame, periods: DataFrame, rows: int | None = None) -> DataFrame:
    """Sliced events with the bounds ``a``, ``b``, ``r`` of the period holding them, others dropped.

    Periods of a machine never overlap, so the one that started last is carried forward along the
    time order instead of a range join. ``_previous`` is the machine's event before.
    """
    marked = events.withColumn("_period", F.lit(None).cast("struct<a:bigint,b:bigint,r:int>")).unionByName(
        periods.select(
            "machine_id",
            F.col("a").alias("timestamp"),
            F.lit(-1).cast("bigint").alias("offset"),
            F.lit(-1).alias("partition"),
            F.struct("a", "b", F.col("r").cast("int").alias("r")).alias("_period"),
        ),
        allowMissingColumns=True,
    )
    is_event = F.col("_period").isNull()
    placed = over_slices(
        slice_by_time(marked, rows=rows),
        TIME_ORDER,
        carry_before={
            "_in": F.col("_period"),
            "_previous": F.when(is_event, F.struct("timestamp", "execution")),
        },
    )
    return placed.filter(is_event & (F.col("timestamp") < F.col("_in.b"))).select(
        *[c for c in placed.columns if c not in ("_period", "_in")], "_in.a", "_in.b", "_in.r"
    )


def runs_in_periods(events: DataFrame, periods: DataFrame, rows: int | None = None) -> DataFrame:
    """First event of each state run inside a period, and the run's end in that period."""
    placed = in_periods(events, periods, rows)
    same_period = F.coalesce(F.col("_previous.timestamp") >= F.col("a"), F.lit(False))
    changed = placed.filter(~same_period | (F.col("execution") != F.col("_previous.execution")))
    slim = changed.select(
        *events.columns, "b", "r", *[c for c in changed.columns if c in SLICE or c.startswith(MARKED)]
    )
    followed = over_slices(slim, TIME_ORDER, lead={"_next": F.col("timestamp")})
    end = F.when(F.col("_next") < F.col("b"), F.col("_next")).otherwise(F.col("b"))
    return followed.select(
        "machine_id",
        F.col("timestamp").alias("start"),
        end.alias("end"),
        (end - F.col("timestamp")).alias("duration"),
        "execution",
        "r",
    )
