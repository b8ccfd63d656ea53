"""Where streams go: files, keyed tables, Kafka, lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millwright.operators.keyed import RECORD_KEY
from millwright.session import new_path, set_streaming
from millwright.sources.tables import run_of, write_batch

# Fixed value: time between writes of the continuous jobs.
TRIGGER = "5 seconds"


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, trigger: str = TRIGGER) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()


def to_files(stream: DataFrame, path: str, checkpoint: str, once: bool = False, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to Parquet files; the file log makes a repeated batch count once."""
    writer = stream.writeStream.format("parquet").option("path", path)
    return _start(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, once)


def to_keyed_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keep: str = "last",
    keys: Sequence[str] = RECORD_KEY,
    once: bool = False,
    trigger: str = TRIGGER,
) -> StreamingQuery:
    """Upsert (``keep="last"``) or insert-ignore (``keep="first"``) by key, batch by batch.

    A batch replayed after a failure replaces itself, so results are the same as if run once. A
    new checkpoint is a new run, later than all runs before it: records read again are written
    again, beside what is there. ``arrival`` says which of several rows of one key came first.
    """
    if "arrival" not in stream.columns:
        raise ValueError("the stream needs a column arrival that orders rows of one key")
    run = run_of(stream.sparkSession, checkpoint)
    return _start(
        stream.writeStream.foreachBatch(lambda batch, n: write_batch(batch, path, n, keep, keys, run)),
        checkpoint,
        once,
        trigger,
    )


def keyed_records(rows: DataFrame) -> DataFrame:
    """Rows as topic records: the machine as key, all columns as JSON, nulls left out."""
    return rows.select(F.col("machine_id").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def to_kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Rows as JSON keyed by machine. Needs the Kafka connector on the class path."""
    writer = (
        keyed_records(stream).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return _start(writer, checkpoint, once)


def watch_lines(records: DataFrame) -> DataFrame:
    """Topic records as lines of time, key and value, as a console consumer prints them."""
    at = F.concat(F.lit("CreateTime:"), F.unix_millis("timestamp"))
    return records.select(F.concat_ws("\t", at, "key", "value").alias("line"))


def to_lines(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Every line of ``watch_lines`` to text files, which ``tail -F`` shows as they come."""
    return _start(stream.select("line").writeStream.format("text").option("path", path), checkpoint, once)


def run_once(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available now and read what it wrote."""
    spark = stream.sparkSession
    set_streaming(spark)
    path = new_path(spark, label)
    to_files(stream, f"{path}/data", f"{path}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")
