"""Topic records from Kafka, or from JSON files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.schemas import TOPIC_RECORD

# Topic names.
INPUT_TOPIC = "input"
EXECUTION_TOPIC = "execution"
COUNTS_TOPIC = "counts"
SESSION_COUNTS_TOPIC = "counts-sessions"

# Most a micro-batch takes from a topic, in rows, or from files.
BATCH_ROWS = 1_000_000
BATCH_BYTES = "268435456"


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = INPUT_TOPIC,
    starting: str = "earliest",
    max_offsets: int = BATCH_ROWS,
) -> DataFrame:
    """A Kafka topic as text records. Needs the Kafka connector on the class path.

    ``max_offsets`` bounds a micro-batch, and with it the rows one key can bring to one task.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("includeHeaders", "true")
        .option("maxOffsetsPerTrigger", max_offsets)
    )
    return as_text(reader.load())


def kafka_batch(spark: SparkSession, servers: str, topic: str = INPUT_TOPIC, starting: str = "earliest") -> DataFrame:
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return as_text(reader.load())


def as_text(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "partition",
        "offset",
        "timestamp",
    )


def json_stream(spark: SparkSession, path: str, batch_bytes: str = BATCH_BYTES) -> DataFrame:
    """Topic records from JSON lines files, with the columns of the Kafka source.

    Files are taken oldest first, as a topic dump appends them.
    """
    return (
        spark.readStream.schema(TOPIC_RECORD).option("maxBytesPerTrigger", batch_bytes).json(path)
    )


def json_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_RECORD).json(path)


def table_stream(spark: SparkSession, folder: str, name: str, batch_bytes: str | None = None) -> DataFrame:
    """The Parquet table ``folder/name.parquet``, a file or a folder of files, as a stream.

    Without ``batch_bytes`` a run takes all files at once: right for counts, whose late rows would
    otherwise depend on the order of the files. Per-machine state needs the bound, and files whose
    age follows their offsets.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # As a glob, since the file source takes a plain path for a folder only.
    reader = spark.readStream.schema(schema)
    if batch_bytes:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    return reader.parquet(f"{folder}/{{{name}}}.parquet")
