"""Profiles of a sample stream. Wide one-pass aggregates; rows are never multiplied per field."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.operators.changes import changes_only, execution_events
from millwright.operators.keyed import looked_up
from millwright.operators.ordered import STREAM_ORDER, over_slices, slice_by_offset


def key_distribution(samples: DataFrame) -> DataFrame:
    return samples.groupBy("machine_id").agg(F.count("*").alias("count"))


def _per_field(one_row: DataFrame, label: str, fields: Sequence[str]) -> DataFrame:
    """Turn the single row of structs into one row per field."""
    return one_row.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias(label), F.col(f).alias("_s")) for f in fields]))
    ).select(label, "_s.*")


def meta_stats(samples: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """avg, min, max and sample standard deviation of every timing column."""
    fields = fields or [c for c in samples.columns if c.startswith("meta_")]
    wide = samples.agg(
        *[
            F.struct(
                F.avg(c).alias("avg"), F.min(c).alias("min"), F.max(c).alias("max"),
                F.stddev_samp(c).alias("stddev"),
            ).alias(c)
            for c in fields
        ]
    )
    return _per_field(wide, "meta", fields)


def meta_averages(decoded: DataFrame) -> DataFrame:
    """Per timing key of the raw message: n, total, mean."""
    return (
        decoded.select(F.explode("meta").alias("key", "value"))
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
    )


def field_presence(samples: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field: how many samples carry it and its newest value as text; key null counts samples
    that carry none."""
    order = F.struct("timestamp", "offset")
    carried = F.greatest(*[F.col(f).isNotNull() for f in fields])
    wide = samples.agg(
        *[
            F.struct(
                F.count(f).alias("count"),
                F.max_by(F.col(f).cast("string"), F.when(F.col(f).isNotNull(), order)).alias("example"),
            ).alias(f)
            for f in fields
        ],
        F.struct(
            F.count_if(~carried).alias("count"), F.lit(None).cast("string").alias("example")
        ).alias("_none"),
    )
    named = _per_field(wide, "key", [*fields, "_none"])
    return named.filter(F.col("count") > 0).withColumn(
        "key", F.when(F.col("key") != "_none", F.col("key"))
    )


def execution_transitions(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Each event with the state and time of the machine's event before, in stream order."""
    return over_slices(
        slice_by_offset(execution_events(samples), rows),
        STREAM_ORDER,
        lag={"p": F.col("execution"), "p_timestamp": F.col("timestamp")},
    )


def execution_counts(samples: DataFrame, anchor: str = "last", rows: int | None = None) -> DataFrame:
    """Per state: completed runs and their mean length in ms.

    ``anchor="last"`` measures from the last sample of a run, ``"first"`` from its first.
    """
    if anchor == "last":
        ended = execution_transitions(samples, rows).filter(F.col("execution") != F.col("p"))
        runs = ended.select(
            F.col("p").alias("execution"), (F.col("timestamp") - F.col("p_timestamp")).alias("duration")
        )
    elif anchor == "first":
        changes = changes_only(slice_by_offset(execution_events(samples), rows), "execution")
        runs = (
            over_slices(changes, STREAM_ORDER, lead={"end": F.col("timestamp")})
            .filter(F.col("end").isNotNull())
            .select("execution", (F.col("end") - F.col("timestamp")).alias("duration"))
        )
    else:
        raise ValueError(f"unknown anchor {anchor!r}")
    return runs.groupBy("execution").agg(F.count("*").alias("count"), F.avg("duration").alias("mean_ms"))


def latest_state_per_machine(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Per machine: the last change of state, from ``previous`` to ``current``, and its time."""
    changed = execution_transitions(samples, rows).filter(~F.col("execution").eqNullSafe(F.col("p")))
    newest = F.max_by(
        F.struct(F.col("p").alias("previous"), F.col("execution").alias("current"), "timestamp"),
        F.struct("partition", "offset"),
    )
    return changed.groupBy("machine_id").agg(newest.alias("s")).select("machine_id", "s.*")


def out_of_order(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Samples older than the machine's sample before them in the stream."""
    paired = over_slices(
        slice_by_offset(samples.select("machine_id", "partition", "offset", "timestamp"), rows),
        STREAM_ORDER,
        lag={"previous": F.col("timestamp")},
    )
    return paired.filter(F.col("previous") > F.col("timestamp")).select(
        "machine_id", "partition", "offset", "timestamp", "previous"
    )


def topic_size(records: DataFrame) -> DataFrame:
    """Next offset of each partition."""
    return records.groupBy("partition").agg((F.max("offset") + 1).alias("size"))


def replay_from(records: DataFrame, back: int) -> DataFrame:
    """The last ``back`` offsets of every partition."""
    ends = records.groupBy("partition").agg(F.max("offset").alias("_end"))
    return looked_up(records, ends, "partition", deal=["offset"]).filter(F.col("offset") > F.col("_end") - back).drop("_end")


def replay_offsets(records: DataFrame, topic: str, back: int) -> str:
    """The same replay as a ``startingOffsets`` value for the Kafka source."""
    starts = topic_size(records).select(
        F.to_json(
            F.struct(
                F.map_from_entries(
                    F.sort_array(
                        F.collect_list(
                            F.struct(F.col("partition").cast("string"), F.greatest(F.col("size") - back, F.lit(0)))
                        )
                    )
                ).alias(topic)
            )
        )
    )
    return starts.first()[0]
