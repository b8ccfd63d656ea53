"""The continuous jobs: a topic to flat samples, and from those everything that follows a machine.

Messages are parsed once, into the flat table; every other stream reads that table, whose file log
lists each file once. With ``once`` the jobs work off what is there and end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millwright.operators.changes import execution_events
from millwright.operators.ingest import flatten_all
from millwright.operators.periods import SESSION_GAP_MS
from millwright.schemas import FLAT
from millwright.sources.topic import BATCH_BYTES
from millwright.streaming import carried, counts, sinks

RECORDS = T.StructType([*FLAT, T.StructField("value", T.StringType()), T.StructField("status", T.StringType())])


def flat_stream(spark: SparkSession, folder: str, batch_bytes: str = BATCH_BYTES) -> DataFrame:
    """The flat samples of ``start_ingest`` as a stream."""
    reader = spark.readStream.schema(RECORDS).option("maxBytesPerTrigger", batch_bytes)
    return reader.parquet(f"{folder}/records").filter(F.col("status") == "flat").select(*FLAT.names)


def _write(stream: DataFrame, folder: str, name: str, once: bool) -> StreamingQuery:
    return sinks.to_files(stream, f"{folder}/{name}/data", f"{folder}/{name}/checkpoint", once)


def start_ingest(records: DataFrame, folder: str, once: bool = False) -> list[StreamingQuery]:
    """Topic records to one table, parsed once and filed by ``status``; the text of undecodable records is kept in ``value``."""
    return [sinks.to_files(flatten_all(records), f"{folder}/records", f"{folder}/checkpoint-records", once, partition_by=["status"])]


def stored(spark: SparkSession, folder: str, status: str) -> DataFrame:
    """What ``start_ingest`` has filed under a status."""
    return spark.read.schema(RECORDS).parquet(f"{folder}/records").filter(F.col("status") == status).drop("status")


def start_tables(samples: DataFrame, folder: str, once: bool = False) -> list[StreamingQuery]:
    """Keyed tables of samples and execution events, safe to write twice."""
    return [
        # An offset is unique in its partition: copies of one key are copies of one record.
        sinks.to_keyed_table(rows.withColumn("arrival", F.col("offset")), f"{folder}/{name}/data", f"{folder}/{name}/checkpoint", once=once)
        for name, rows in (("samples", samples), ("execution", execution_events(samples)))
    ]


def start_counts(samples: DataFrame, folder: str, once: bool = False, servers: str | None = None) -> list[StreamingQuery]:
    """Counts per minute and per session, each written when it can no longer change; with ``servers`` also to the topics
    ``counts`` and ``counts-sessions``, keyed by machine."""
    streams = {"counts": counts.window_counts(samples), "counts-sessions": counts.session_counts(samples)}
    started = [_write(stream, folder, name, once) for name, stream in streams.items()]
    if servers:
        started += [sinks.to_kafka(stream, servers, name, f"{folder}/{name}/checkpoint-topic", once) for name, stream in streams.items()]
    return started


def start_state(samples: DataFrame, folder: str, gap_ms: int = SESSION_GAP_MS, once: bool = False) -> list[StreamingQuery]:
    """Run durations, completed parts, sessions of state changes and running session counts."""
    steps = {
        "runs": carried.execution_run_duration(),
        "parts": carried.part_completed_events(),
        "tagged": carried.execution_with_session(gap_ms),
        "sessions": carried.session_counts_live(gap_ms),
    }
    return [carried.start(samples, f"{folder}/{name}", step, once) for name, step in steps.items()]
