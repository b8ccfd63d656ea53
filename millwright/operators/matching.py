"""Matching along time: as-of programs, stream-to-table, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.text import content_hash, one_line, present
from millwright.operators.keyed import looked_up
from millwright.operators.ordered import (
    KEYS,
    over_slices,
    slice_by_offset,
    slice_by_time,
    slice_rows,
    unsliced,
)
from millwright.operators.periods import SESSION_GAP_MS, sessions


def programs(samples: DataFrame) -> DataFrame:
    """Samples that carry a program, with the hash of its text."""
    return samples.filter(present("program")).select(
        "machine_id",
        "timestamp",
        "offset",
        "partition",
        content_hash("program").alias("hash"),
        F.col("program").alias("contents"),
    )


def part_counts(samples: DataFrame) -> DataFrame:
    return samples.filter(F.col("part_count") > 0).select(
        "machine_id", "timestamp", "offset", "partition", "part_count"
    )


def asof_before(
    left: DataFrame,
    right: DataFrame,
    value: Column,
    rows: int | None = None,
    lag: dict[str, Column] | None = None,
) -> DataFrame:
    """Left rows with ``_matched``, ``value`` of the newest right row strictly earlier in ``timestamp``.

    Both sides go through one ordered pass that carries the value along, so a right row matched by
    very many left rows makes no hot join key. At equal times left rows come first and never see a
    right row of their own time. ``lag`` adds values of the previous left row.
    """
    both = left.withColumn("_kind", F.lit(0)).unionByName(
        right.select(*KEYS, "timestamp", "offset", value.alias("_value")).withColumn("_kind", F.lit(1)),
        allowMissingColumns=True,
    )
    rows = slice_rows(left, rows)
    tie = F.expr(f"_kind * {2**40} + offset div {rows}")
    is_left = F.col("_kind") == 0
    previous = {n: F.when(is_left, F.struct(c.alias("v"))) for n, c in (lag or {}).items()}
    found = over_slices(
        slice_by_time(both, tie=tie, rows=rows),
        ("timestamp", "_kind", "offset"),
        carry_before={"_matched": F.when(~is_left, F.col("_value")), **previous},
    )
    return unsliced(
        found.filter(is_left).select(
            *left.columns, "_matched", *[F.col(f"{n}.v").alias(n) for n in previous]
        )
    )


def completed_program_parts(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Increases of the part counter with the program running in an earlier second."""
    second = clock.to_second("timestamp")
    parts = part_counts(samples).withColumn("timestamp", second)
    loaded = samples.filter(F.col("program").isNotNull()).select(
        "machine_id", "offset", second.alias("timestamp"), "program"
    )
    increases = asof_before(
        parts, loaded, F.struct("timestamp", "program"), rows, lag={"previous": F.col("part_count")}
    ).filter((F.col("part_count") > F.col("previous")) & F.col("_matched").isNotNull())
    return increases.select(
        "machine_id",
        "timestamp",
        "part_count",
        F.col("_matched.timestamp").alias("program_timestamp"),
        one_line("_matched.program").alias("program"),
    )


def program_table_by_machine(samples: DataFrame) -> DataFrame:
    """The program each machine loaded last."""
    return _newest(programs(samples), "machine_id")


def program_table_by_hash(samples: DataFrame) -> DataFrame:
    """The newest load of each program text."""
    return _newest(programs(samples), "hash")


def _newest(loads: DataFrame, key: str) -> DataFrame:
    fields = ("machine_id", "timestamp", "offset", "hash", "contents")
    return (
        loads.groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(F.struct(*fields), F.struct("timestamp", "offset")).alias("newest"))
        .select("newest.*")
    )


def counts_and_loads(samples: DataFrame) -> DataFrame:
    """Part counts and program loads in one table; ``_kind`` puts a load before a count of its own record."""
    counts = part_counts(samples).withColumn("_kind", F.lit(1))
    loads = samples.filter(present("program")).select(
        "machine_id", "timestamp", "offset", "partition", "program", F.lit(0).alias("_kind")
    )
    return counts.unionByName(loads, allowMissingColumns=True)


def completed_parts(sliced: DataFrame, wanted: Column) -> DataFrame:
    """Changes of the part counter among the ``wanted`` rows of sliced ``counts_and_loads``, with the program loaded at that point."""
    is_count = F.col("_kind") == 1
    walked = over_slices(
        sliced,
        ("partition", "offset", "_kind"),
        carry_before={
            "_loaded": F.when(~is_count, F.struct("timestamp", "program")),
            "_last": F.when(is_count, F.col("part_count")),
        },
    )
    return walked.filter(
        wanted
        & is_count
        & (F.col("_last").isNull() | (F.col("part_count") != F.col("_last")))
        & F.col("_loaded").isNotNull()
    ).select(
        "machine_id",
        "timestamp",
        "offset",
        "part_count",
        F.col("timestamp").alias("part_count_timestamp"),
        F.col("_loaded.program").alias("program"),
        content_hash("_loaded.program").alias("program_hash"),
        F.col("_loaded.timestamp").alias("program_timestamp"),
    )


def part_completed_events(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Changes of the part counter joined with the machine's program at that point of the stream.

    A program in the same record counts as loaded; changes before the first program are dropped.
    """
    return completed_parts(slice_by_offset(counts_and_loads(samples), rows), F.lit(True))


def session_lookup(
    events: DataFrame,
    sessions_: DataFrame,
    lookup: str = "containing",
    rows: int | None = None,
) -> DataFrame:
    """Events with the start of their session, -1 if there is none.

    ``lookup="first"`` gives the machine's first session instead of the one holding the event.
    """
    if lookup == "first":
        first = sessions_.groupBy("machine_id").agg(F.min("windowStart").alias("session"))
        return looked_up(events, first, "machine_id", deal=["timestamp", "offset"]).fillna({"session": -1})
    if lookup != "containing":
        raise ValueError(f"unknown lookup {lookup!r}")
    marked = events.unionByName(
        sessions_.select(
            "machine_id",
            F.col("windowStart").alias("timestamp"),
            F.lit(-1).cast("bigint").alias("offset"),
            F.struct("windowStart", "windowEnd").alias("_session"),
        ),
        allowMissingColumns=True,
    )
    placed = over_slices(
        slice_by_time(marked, rows=rows),
        ("timestamp", "offset"),
        carry={"_in": F.col("_session")},
    )
    held = F.col("timestamp") <= F.col("_in.windowEnd")
    return placed.filter(F.col("_session").isNull()).select(
        *events.columns,
        F.when(held, F.col("_in.windowStart")).otherwise(F.lit(-1)).cast("bigint").alias("session"),
    )


def execution_with_session(
    changes: DataFrame, samples: DataFrame, gap_ms: int = SESSION_GAP_MS, lookup: str = "containing", rows: int | None = None
) -> DataFrame:
    """Execution changes tagged with the activity session of their machine."""
    return session_lookup(changes, sessions(samples, gap_ms), lookup, rows)
