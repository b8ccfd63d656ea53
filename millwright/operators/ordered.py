"""Row-to-row operators in per-machine order that stay balanced when a machine is hot.

A plain ``Window.partitionBy("machine_id")`` would send every row of a machine to one task. Here each
machine's history is always cut into slices that follow one another in order. A window runs inside
each slice; one summary row per slice, taken from the windowed rows at its ends, then carries the
missing neighbour, value or running total over the slice borders. Slices are a function of the data
alone, so a recomputed task cuts them alike, and building the plan starts no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("machine_id",)
SLICE = ("_slice", "_part")
#: A key's text with a mark before it, empty for null. It is never null, so rows meet their slice's border by plain equality, where they lie.
MARKED = "_key_"
STREAM_ORDER = ("partition", "offset")
TIME_ORDER = ("timestamp", "offset", "partition")

#: Rows that a slice should not exceed, and the setting that replaces the number for a session.
SLICE_ROWS = 1_000_000
SLICE_ROWS_SETTING = "millwright.slice.rows"
#: Slices by time are hours; where an hour holds too many rows minutes, then seconds, then milliseconds.
HOUR, MINUTE, SECOND = 3_600_000, 60_000, 1_000

Columns = Mapping[str, Column]


def floor_to(ms: Column, width_ms: int) -> Column:
    """Start of the ``width_ms`` interval holding ``ms``, also before 1970."""
    return ms - F.pmod(ms, F.lit(width_ms))


def slice_rows(df: DataFrame, rows: int | None) -> int:
    return rows or int(df.sparkSession.conf.get(SLICE_ROWS_SETTING, str(SLICE_ROWS)))


def slice_by_offset(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Slices for stream order: runs of offsets. Offsets are unique in a partition, so no slice exceeds ``rows``."""
    return df.withColumn("_slice", F.coalesce(F.col("partition").cast("long"), F.lit(-1))).withColumn(
        "_part", F.coalesce(F.expr(f"offset div {slice_rows(df, rows)}"), F.lit(-1))
    )


def crowded_seconds(df: DataFrame, keys: Sequence[str], ts: str, rows: int) -> DataFrame:
    """The seconds of hours that hold more than ``rows`` rows, with the width of the slices they need.

    Rows are counted once, by second and combined before the shuffle; minutes and hours follow from these counts.
    """
    seconds = df.groupBy(*keys, floor_to(F.col(ts), SECOND).alias("_second")).agg(F.count("*").alias("_n"))
    seconds = seconds.withColumn("_hour", floor_to(F.col("_second"), HOUR))
    hour = Window.partitionBy(*keys, "_hour")
    minute = Window.partitionBy(*keys, "_hour", floor_to(F.col("_second"), MINUTE))
    crowded = seconds.select("*", F.sum("_n").over(hour).alias("_in_hour"), F.sum("_n").over(minute).alias("_in_minute"))
    width = F.when(F.col("_in_minute") <= rows, MINUTE).when(F.col("_n") <= rows, SECOND).otherwise(1)
    return crowded.filter(F.col("_in_hour") > rows).select(*keys, "_second", width.cast("long").alias("_width"))


def slice_by_time(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = "timestamp",
    tie: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Slices for time order: hours, with crowded hours cut into minutes, seconds, milliseconds.

    ``tie`` numbers pieces of a crowded millisecond and must grow with the order that follows
    ``ts``; by default pieces of ``rows`` offsets. Every row is counted, so each second of a crowded
    hour that has a row is cut as its neighbours are.
    """
    rows = slice_rows(df, rows)
    tie = F.expr(f"offset div {rows}") if tie is None else tie
    crowded = crowded_seconds(df, keys, ts, rows)
    time, width = F.col(ts), F.col("_width")
    return (
        df.withColumn("_second", floor_to(time, SECOND))
        .join(crowded, [*keys, "_second"], "left")
        # Rows without a time come first, as they do in the order itself, in pieces like those of a crowded millisecond.
        .withColumn("_slice", F.coalesce(time - F.pmod(time, F.coalesce(width, F.lit(HOUR).cast("long"))), F.lit(-(2**62))))
        .withColumn("_part", F.coalesce(F.when((width == 1) | time.isNull(), tie).otherwise(F.lit(0)).cast("long"), F.lit(-1)))
        .select(*df.columns, *SLICE)
    )


def marked_key(key: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _row(columns: Columns) -> Column:
    return F.struct(F.lit(True).alias("_row"), *[c.alias(n) for n, c in columns.items()])


def over_slices(
    df: DataFrame,
    by: Sequence[str] = TIME_ORDER,
    keys: Sequence[str] = KEYS,
    *,
    lag: Columns | None = None,
    lead: Columns | None = None,
    carry: Columns | None = None,
    carry_before: Columns | None = None,
    total: Columns | None = None,
    peak: Columns | None = None,
) -> DataFrame:
    """Add columns computed over each key's whole order to sliced rows.

    ``lag`` / ``lead``: value of the previous / next row. ``carry``: last non-null value up to the
    row; ``carry_before``: strictly before it. ``total``: running sum. ``peak``: running maximum.

    Rows are shuffled once, by their slice, and keep that place, so a further call on the
    result shuffles none. The branch that sums up the slices asks for all columns, as the rows do, so both
    read one shuffle; keep ``df`` to the columns that are wanted.
    """
    lag, lead, carry = dict(lag or {}), dict(lead or {}), dict(carry or {})
    before, total, peak = dict(carry_before or {}), dict(total or {}), dict(peak or {})
    marked = [f"{MARKED}{k}" for k in keys]
    kept = [c for c in df.columns if c not in marked]
    df = df.withColumns({m: marked_key(k) for m, k in zip(marked, keys, strict=True) if m not in df.columns})
    place = [*marked, *SLICE]

    inside = Window.partitionBy(*place).orderBy(*by)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    held = {**carry, **before}
    local = df.select(
        "*",
        F.lag(_row(lag)).over(inside).alias("_prev"),
        F.lead(_row(lead)).over(inside).alias("_next"),
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_at_{n}") for n, c in held.items()],
        *[F.last(c, ignorenulls=True).over(earlier).alias(f"_before_{n}") for n, c in before.items()],
        *[F.sum(c).over(upto).alias(f"_sum_{n}") for n, c in total.items()],
        *[F.max(c).over(upto).alias(f"_max_{n}") for n, c in peak.items()],
    )
    is_first, is_last = F.col("_prev").isNull(), F.col("_next").isNull()

    # One row per slice, from its first and last row; the last one has seen all values and sums.
    seen = [f"_at_{n}" for n in held] + [f"_sum_{n}" for n in total] + [f"_max_{n}" for n in peak]
    whole = F.struct(*kept).alias("_whole")
    head = F.struct(whole, *[c.alias(f"_lead_{n}") for n, c in lead.items()])
    tail = F.struct(whole, *[c.alias(f"_lag_{n}") for n, c in lag.items()], *seen)
    ends = local.filter(is_first | is_last).groupBy(*place).agg(
        F.first(F.when(is_first, head), ignorenulls=True).alias("_head"),
        F.first(F.when(is_last, tail), ignorenulls=True).alias("_tail"),
    )
    across = Window.partitionBy(*marked).orderBy(*SLICE)
    past = across.rowsBetween(Window.unboundedPreceding, -1)
    borders = ends.select(
        *[F.col(c).alias(f"_of{c}") for c in place],
        *[F.lag(f"_tail._lag_{n}").over(across).alias(f"_from_{n}") for n in lag],
        *[F.lead(f"_head._lead_{n}").over(across).alias(f"_to_{n}") for n in lead],
        *[F.last(f"_tail._at_{n}", ignorenulls=True).over(past).alias(f"_in_at_{n}") for n in held],
        *[F.sum(f"_tail._sum_{n}").over(past).alias(f"_in_sum_{n}") for n in total],
        *[F.max(f"_tail._max_{n}").over(past).alias(f"_in_max_{n}") for n in peak],
    )
    same = reduce(and_, (F.col(c) == F.col(f"_of{c}") for c in place))
    return local.join(borders, same, "left").select(
        *[F.col(c) for c in kept],
        *marked,
        *[F.when(is_first, F.col(f"_from_{n}")).otherwise(F.col(f"_prev.{n}")).alias(n) for n in lag],
        *[F.when(is_last, F.col(f"_to_{n}")).otherwise(F.col(f"_next.{n}")).alias(n) for n in lead],
        *[F.coalesce(f"_at_{n}", f"_in_at_{n}").alias(n) for n in carry],
        *[F.coalesce(f"_before_{n}", f"_in_at_{n}").alias(n) for n in before],
        *[F.coalesce(F.col(f"_sum_{n}") + F.col(f"_in_sum_{n}"), f"_sum_{n}", f"_in_sum_{n}").alias(n) for n in total],
        *[F.greatest(f"_max_{n}", f"_in_max_{n}").alias(n) for n in peak],
    )


def unsliced(df: DataFrame) -> DataFrame:
    """Drop the slice columns."""
    return df.drop(*SLICE, *(c for c in df.columns if c.startswith(MARKED)))
