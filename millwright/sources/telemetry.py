"""Samples, readings and messages derived from an ``events`` table.

The event log stands in for a telemetry topic: one event is one message, the user number picks
one of six machines, and the event type decides which sparse fields a message carries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.schemas import AXIS, META_KEYS, VALUES


def event_millis(column: str = "ts"):
    return F.unix_millis(F.col(column).cast("timestamp"))


def samples_from_events(events: DataFrame) -> DataFrame:
    """Flat samples; null means the message did not carry the field."""
    kind, user, event = F.col("event_type"), F.col("user_id"), F.col("event_id")
    return events.select(
        F.concat(F.lit("m"), (user % 6).cast("string")).alias("machine_id"),
        event.alias("offset"),
        event_millis().alias("timestamp"),
        (user % 6).cast("int").alias("partition"),
        F.when(kind == "purchase", "ACTIVE")
        .when(kind == "click", "INTERRUPTED")
        .when(kind == "view", "READY")
        .when(kind == "signup", "STOPPED")
        .alias("execution"),
        F.when(kind == "purchase", F.floor(F.col("value") / 10).cast("bigint")).alias("part_count"),
        F.when(
            kind == "signup",
            F.concat(F.lit("O000"), (event % 7).cast("string"), F.lit("\n\rG91")),
        ).alias("program"),
        (event % 50).cast("int").alias("sequence"),
        F.when(kind == "signup", (user % 9).cast("int")).alias("mprogram"),
        F.when(kind.isin("signup", "click"), (event % 11).cast("int")).alias("cprogram"),
        F.when(kind == "click", (event % 13).cast("int")).alias("program_number"),
        F.when(kind == "error", F.concat(F.lit("//CNC_MEM/O"), (event % 7).cast("string"))).alias("program_path_alt"),
        F.when(kind == "click", F.concat(F.lit("G01X"), F.floor("value").cast("string")))
        .when(kind == "view", "")
        .alias("block"),
        F.when(kind == "click", F.floor("value").cast("bigint")).alias("block_num"),
        F.floor(F.col("value") * 100).cast("bigint").alias("meta_total"),
        F.when(kind.isin("view", "error"), user).alias("meta_status"),
    )


def readings_from_events(events: DataFrame) -> DataFrame:
    """Dense raw readings: every field is read at every poll."""
    value = F.floor("value").cast("int")
    return events.select(
        F.concat(F.lit("m"), (F.col("user_id") % 6).cast("string")).alias("machine_id"),
        F.col("event_id").alias("offset"),
        event_millis().alias("timestamp"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        (value % 6).cast("int").alias("run"),
        (F.col("user_id") % 4).cast("int").alias("motion"),
        (F.length("event_type") % 3).cast("int").alias("mstb"),
        (value % 9).cast("int").alias("aut"),
        (F.col("event_id") % 2).cast("int").alias("emergency"),
        (F.floor(F.col("event_id") / 7) % 3).cast("int").alias("cprogram"),
        (F.floor(F.col("event_id") / 31) % 4).cast("int").alias("mprogram"),
        (F.floor(F.col("event_id") / 11)).cast("bigint").alias("part_count"),
        F.col("props").alias("program"),
        value.cast("bigint").alias("cycle_time"),
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """Topic records with JSON text; errors are cut short and cannot be decoded."""
    samples = samples_from_events(events)
    values = F.to_json(
        F.struct(
            "execution", "part_count", "program", "sequence", "mprogram", "cprogram", "block", "block_num",
            F.when(
                F.col("block_num").isNotNull(),
                F.array(F.col("block_num") / 4, F.col("sequence") / 2),
            ).alias("actual"),
            F.when(F.col("part_count").isNotNull(), F.array().cast("array<double>")).alias("load"),
        )
    )
    meta = F.to_json(
        F.struct(F.col("meta_total").alias("total"), F.col("meta_status").alias("status"))
    )
    text = F.concat(F.lit('{"values":'), values, F.lit(',"meta":'), meta, F.lit("}"))
    broken = F.col("execution").isNull()
    return samples.select(
        F.col("machine_id").alias("key"),
        F.when(broken, F.substring(text, 1, 25)).otherwise(text).alias("value"),
        "partition",
        "offset",
        F.timestamp_millis("timestamp").alias("timestamp"),
    )


#: A stand-in axis record.
AXIS_ROW = {"id": "X1", "name": "X", "index": 1, "suffix": "", "divisor": 1000, "flag": 0, "unit": 0, "unith": "mm", "decimal": 3}


def full_messages_from_events(events: DataFrame) -> DataFrame:
    """Topic records that carry every field of a message, a third of the fields at a time.

    Field number ``i`` is there where ``event_id + i`` leaves 0 by 3; arrays are empty where it leaves 1. State and program
    follow ``samples_from_events``; errors are cut short.
    """
    event = F.col("offset")

    def value(i: int, name: str, kind: T.DataType) -> Column:
        there = (event + i) % 3 == 0
        if name in ("execution", "program"):
            return F.col(name)
        if name == "axes":
            row = F.struct(*(F.lit(AXIS_ROW[f.name]).cast(f.dataType).alias(f.name) for f in AXIS))
            return F.when(there, F.array(row)).when((event + i) % 3 == 1, F.array().cast(kind))
        if isinstance(kind, T.ArrayType):
            return F.when(there, F.array(event / 4, (event % 8) / 2)).when((event + i) % 3 == 1, F.array().cast(kind))
        if isinstance(kind, T.StringType):
            return F.when(there, F.concat(F.lit(f"{name}-"), (event % 11).cast("string")))
        return F.when(there, event * 1000 + i if isinstance(kind, T.LongType) else (event * (i + 1)) % 1000)

    samples = samples_from_events(events)
    values = F.to_json(F.struct(*(value(i, f.name, f.dataType).cast(f.dataType).alias(f.name) for i, f in enumerate(VALUES))))
    meta = F.to_json(F.struct(*(F.when((event + j) % 4 != 0, event + j).alias(k) for j, k in enumerate(META_KEYS))))
    text = F.concat(F.lit('{"values":'), values, F.lit(',"meta":'), meta, F.lit("}"))
    return samples.select(
        F.col("machine_id").alias("key"),
        F.when(F.col("execution").isNull(), F.substring(text, 1, 25)).otherwise(text).alias("value"),
        "partition", "offset", F.timestamp_millis("timestamp").alias("timestamp"),
    )
