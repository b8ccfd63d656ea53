"""State time per interval: each run is cut along the bin edges it crosses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.clock import HOUR_MS
from millwright.operators.ordered import floor_to
from millwright.schemas import STATES

# Fixed value: default bin width.
BIN_MS = 300_000


def overlap_bins(runs: DataFrame, width_ms: int = BIN_MS, strict_edges: bool = False) -> DataFrame:
    """One row per run and bin it overlaps: machine_id, execution, b (bin start), overlap_ms.

    Bins are counted from the full hour of the first start, which matters only for widths that do
    not divide an hour. A run names its own bins, so there is no join against the bin list.
    ``strict_edges`` leaves out a run's first bin when the run starts exactly on its edge.
    """
    origin = F.lit(0) if HOUR_MS % width_ms == 0 else runs.agg(floor_to(F.min("start"), HOUR_MS)).scalar()
    start, end = F.col("start"), F.col("end")
    first = start - F.pmod(start - origin, F.lit(width_ms))
    last = end - 1 - F.pmod(end - 1 - origin, F.lit(width_ms))
    if strict_edges:
        first = F.when(first == start, first + width_ms).otherwise(first)
    inside = F.when(first <= last, F.sequence(first, last, F.lit(width_ms)))
    return (
        runs.select("machine_id", "execution", "start", "end", F.explode(inside).alias("b"))
        .select(
            "machine_id",
            "execution",
            "b",
            (F.least(F.col("b") + width_ms, "end") - F.greatest("b", "start")).alias("overlap_ms"),
        )
    )


def execution_distribution(runs: DataFrame, width_ms: int = BIN_MS, strict_edges: bool = False) -> DataFrame:
    """machine_id, execution, b, sum_ms."""
    return (
        overlap_bins(runs, width_ms, strict_edges)
        .groupBy("machine_id", "execution", "b")
        .agg(F.sum("overlap_ms").alias("sum_ms"))
    )


def state_totals(distribution: DataFrame) -> DataFrame:
    """One row per machine and bin with a column of ms per state, 0 where the state is absent."""
    return distribution.groupBy("machine_id", "b").agg(
        *[
            F.sum(F.when(F.col("execution") == s, F.col("sum_ms")).otherwise(0)).alias(s.lower())
            for s in STATES
        ]
    )


def execution_distribution_totals(runs: DataFrame, width_ms: int = BIN_MS, strict_edges: bool = False) -> DataFrame:
    """The totals straight from the clipped runs, for a bin width the caller chooses."""
    return (
        overlap_bins(runs, width_ms, strict_edges)
        .groupBy("machine_id", "b")
        .agg(
            *[
                F.sum(F.when(F.col("execution") == s, F.col("overlap_ms")).otherwise(0)).alias(s.lower())
                for s in STATES
            ]
        )
    )


def activity_hours(totals: DataFrame) -> DataFrame:
    return totals.select(
        "machine_id", "b", *[(F.col(s.lower()) / HOUR_MS).alias(s.lower()) for s in STATES]
    )
