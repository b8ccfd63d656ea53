"""Topic records to samples: tolerant decoding, flattening, filters and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.functions.text import content_hash, present
from millwright.operators.ordered import over_slices, slice_by_offset, unsliced
from millwright.schemas import ARRAY_FIELDS, FLAT, LEGACY_TEXT, MESSAGE, META_KEYS, VALUE_FIELDS

POSITION_FIELDS = (
    "program_number", "program_path_alt", "mprogram", "cprogram", "sequence", "block", "block_num",
)


def _parsed(records: DataFrame) -> DataFrame:
    """Topic records with ``values`` and ``meta``, null where the text is malformed.

    A generator hands the parsed struct on; as a plain column it would be parsed again for every
    later use.
    """
    message = F.from_json("value", MESSAGE, {"mode": "PERMISSIVE"})
    return records.select(*records.columns, F.inline(F.array(message)))


def decode(records: DataFrame) -> DataFrame:
    """Topic records with ``values`` and ``meta``; records that cannot be decoded are skipped."""
    return (
        _parsed(records)
        .filter(F.col("values").isNotNull() & F.col("meta").isNotNull())
        .select("key", "partition", "offset", "timestamp", "values", "meta")
    )


def undecodable(records: DataFrame) -> DataFrame:
    """The records ``decode`` skips, for a side output."""
    parsed = _parsed(records)
    return parsed.filter(F.col("values").isNull() | F.col("meta").isNull()).select(*records.columns)


def flatten_all(records: DataFrame) -> DataFrame:
    """Every topic record, parsed once: its flat sample, the record's text where it is of no use, and the ``status``
    ``flat``, ``untimed`` (no usable event time) or ``undecodable``."""
    parsed = _parsed(records)
    usable = F.col("values").isNotNull() & F.col("meta").isNotNull()
    timed = F.coalesce(F.unix_millis("timestamp") >= 0, F.lit(False))
    status = F.when(~usable, "undecodable").when(~timed, "untimed").otherwise("flat")
    return parsed.select(*_flat_columns(), F.when(~usable, F.col("value")).alias("value"), status.alias("status"))


def _value(name: str) -> Column:
    field = F.col(f"values.{name}")
    if name in ARRAY_FIELDS:
        return F.when(F.size(field) > 0, F.to_json(field)).alias(name)
    return field.alias(name)


def _flat_columns() -> list[Column]:
    return [
        F.col("key").alias("machine_id"),
        F.col("offset"),
        F.unix_millis("timestamp").alias("timestamp"),
        F.col("partition"),
        *[_value(n) for n in VALUE_FIELDS],
        *[F.col("meta")[k].alias(f"meta_{k}") for k in META_KEYS],
    ]


def flatten(decoded: DataFrame) -> DataFrame:
    """Flat samples: array fields as JSON text unless empty, one column per timing key."""
    return decoded.select(*_flat_columns())


def flatten_generic(decoded: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Flat samples restricted to a column list.

    Any listed ``meta_<key>`` is looked up in the timings; columns nothing fills are null text.
    """
    columns = columns or [*FLAT.names, *LEGACY_TEXT]
    timings = [c for c in columns if c.startswith("meta_") and c not in FLAT.names]
    flat = decoded.select(
        *_flat_columns(), *[F.col("meta")[c.removeprefix("meta_")].alias(c) for c in timings]
    )
    return flat.select(
        *[F.col(c) if c in flat.columns else F.lit(None).cast(T.StringType()).alias(c) for c in columns]
    )


def execution_present(samples: DataFrame) -> DataFrame:
    return samples.filter(present("execution"))


def project_execution(samples: DataFrame) -> DataFrame:
    return samples.select("machine_id", "execution", "timestamp", "offset", "partition")


def project_part_count(samples: DataFrame) -> DataFrame:
    return samples.select("machine_id", "timestamp", "offset", "part_count")


def project_program(samples: DataFrame) -> DataFrame:
    return samples.select(
        "machine_id", "timestamp", "offset",
        content_hash("program").alias("hash"), F.col("program").alias("contents"),
    )


def unpivot_fields(samples: DataFrame, fields: Sequence[str] = POSITION_FIELDS) -> DataFrame:
    """One row per sample and present field, the value as text."""
    ids = [c for c in ("machine_id", "timestamp", "offset") if c in samples.columns]
    as_text = samples.select(*ids, *[F.col(f).cast("string").alias(f) for f in fields])
    return as_text.unpivot(ids, list(fields), "key", "value").filter(F.col("value").isNotNull())


def power_of_two_offsets(samples: DataFrame) -> DataFrame:
    """Log-spaced progress rows: counters 0, 1, 2, 4, 8, ..."""
    at = F.col("offset")
    return samples.filter(at.bitwiseAND(at - 1) == 0)


def executing_blocks(samples: DataFrame) -> DataFrame:
    return samples.filter(present("block")).select("machine_id", "timestamp", "offset", "block")


def split_by_event_time(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples with a usable event time, and those whose time is invalid, for a side output."""
    valid = F.coalesce(F.col("timestamp") >= 0, F.lit(False))
    return samples.filter(valid), samples.filter(~valid)


def repair_event_time(samples: DataFrame, rows: int | None = None) -> DataFrame:
    """Invalid times become the highest time seen earlier in the partition, null if there is none."""
    seen = over_slices(
        slice_by_offset(samples, rows),
        ("offset",),
        ("partition",),
        peak={"_seen": F.when(F.col("timestamp") >= 0, F.col("timestamp"))},
    )
    usable = F.when(F.col("timestamp") >= 0, F.col("timestamp")).otherwise(F.col("_seen"))
    return unsliced(seen.withColumn("timestamp", usable).drop("_seen"))
