"""Dense device readings to sparse change-only samples and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.operators.ordered import (
    STREAM_ORDER,
    over_slices,
    slice_by_offset,
)

# Fixed value: which field's change makes the device read the others.
TRIGGERS: Mapping[str, Sequence[str]] = {
    "cprogram": ("program_name", "program_path", "program_header"),
    "mprogram": ("program", "program_size"),
    "part_count": ("cycle_time",),
}
# Fixed value: a message number of -1 empties the message text.
CLEARED: Mapping[str, str] = {"message_text": "message_number = -1"}


def _previous(sliced: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Sliced readings with ``_before``, the machine's reading before; null for its first."""
    return over_slices(sliced, STREAM_ORDER, lag={"_before": F.struct(*fields)})


def _differs(field: str):
    return F.col("_before").isNull() | ~F.col(field).eqNullSafe(F.col(f"_before.{field}"))


def encoded(sliced: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Null out every field that equals the machine's reading before; readings are sliced."""
    return _previous(sliced, fields).select(*[F.when(_differs(c), F.col(c)).alias(c) if c in fields else F.col(c) for c in sliced.columns])


def delta_encode(readings: DataFrame, fields: Sequence[str], rows: int | None = None) -> DataFrame:
    """Null out every field that equals the machine's reading before."""
    return encoded(slice_by_offset(readings, rows), fields).select(*readings.columns)


def decoded(sliced: DataFrame, fields: Sequence[str], cleared: Mapping[str, str] = CLEARED) -> DataFrame:
    """The full state of the machine after each sliced sample; see ``delta_decode``."""
    known = {
        c: F.col(c).isNotNull() | F.coalesce(F.expr(cleared[c]), F.lit(False))
        if c in cleared and cleared[c].split()[0] in sliced.columns
        else F.col(c).isNotNull()
        for c in fields
    }
    state = over_slices(
        sliced,
        STREAM_ORDER,
        carry={f"_full_{c}": F.when(known[c], F.struct(F.col(c).alias("v"))) for c in fields},
    )
    return state.select(*[F.col(f"_full_{c}.v").alias(c) if c in fields else F.col(c) for c in sliced.columns])


def delta_decode(
    samples: DataFrame,
    fields: Sequence[str],
    rows: int | None = None,
    cleared: Mapping[str, str] = CLEARED,
) -> DataFrame:
    """The full state of the machine after each sample.

    A null field is unchanged, except where its condition in ``cleared`` says it was emptied.
    """
    return decoded(slice_by_offset(samples, rows), fields, cleared).select(*samples.columns)


def causes(columns: Sequence[str], triggers: Mapping[str, Sequence[str]] = TRIGGERS) -> dict[str, str]:
    """The trigger of every dependent field among ``columns``."""
    return {c: t for t, cs in triggers.items() if t in columns for c in cs if c in columns}


def triggered(sliced: DataFrame, triggers: Mapping[str, Sequence[str]] = TRIGGERS) -> DataFrame:
    cause = causes(sliced.columns, triggers)
    paired = _previous(sliced, [t for t in triggers if t in sliced.columns])
    return paired.select(*[F.when(_differs(cause[c]), F.col(c)).alias(c) if c in cause else F.col(c) for c in sliced.columns])


def triggered_fields(
    readings: DataFrame, triggers: Mapping[str, Sequence[str]] = TRIGGERS, rows: int | None = None
) -> DataFrame:
    """Keep dependent fields only where the field that triggers reading them changed."""
    return triggered(slice_by_offset(readings, rows), triggers).select(*readings.columns)
