"""Activity periods, sessions and dense bins.

Everything starts from counts per (machine, interval), which are combined on the map side. What
is left per machine is bounded by the time covered divided by the interval width, not by rows,
so plain windows per machine are used from there on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.operators.ordered import floor_to

# Interval widths and thresholds.
BUCKET_MS = 300_000
DENSE_MS = 1_800_000
SUFFICIENT = 1000
SESSION_GAP_MS = 300_000
GRACE_MS = 60_000
TUMBLING_MS = 60_000
HOUR_MS = 3_600_000


def per_machine(*order: str, keys: Sequence[str] = ("machine_id",)):
    return Window.partitionBy(*keys).orderBy(*order)


def count_per_bucket(samples: DataFrame, width_ms: int = BUCKET_MS) -> DataFrame:
    """machine_id, bucket (start, ms), cnt."""
    return samples.groupBy("machine_id", floor_to(F.col("timestamp"), width_ms).alias("bucket")).agg(
        F.count("*").alias("cnt")
    )


def island_starts(df: DataFrame, order: str, starts: Column, keys: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Number the islands of each machine in ``g``; a row where ``starts`` holds opens one."""
    return df.withColumn("g", F.sum(F.when(starts, 1).otherwise(0)).over(per_machine(order, keys=keys)))


def bucket_islands(samples: DataFrame, width_ms: int = BUCKET_MS) -> DataFrame:
    """Buckets with the number of the period they belong to."""
    buckets = count_per_bucket(samples, width_ms).withColumn(
        "previous", F.lag("bucket").over(per_machine("bucket"))
    )
    gap = F.col("previous").isNull() | (F.col("previous") + width_ms < F.col("bucket"))
    return island_starts(buckets, "bucket", gap).drop("previous")


def activity_periods(samples: DataFrame, width_ms: int = BUCKET_MS) -> DataFrame:
    """Stretches of consecutive non-empty buckets: machine_id, a, b, duration, r, cnt (ms)."""
    return (
        bucket_islands(samples, width_ms)
        .groupBy("machine_id", "g")
        .agg(
            F.min("bucket").alias("a"),
            (F.max("bucket") + width_ms).alias("b"),
            F.sum("cnt").alias("cnt"),
        )
        .select(
            "machine_id",
            "a",
            "b",
            (F.col("b") - F.col("a")).alias("duration"),
            F.row_number().over(per_machine("a")).alias("r"),
            "cnt",
        )
    )


def sessions(samples: DataFrame, gap_ms: int = SESSION_GAP_MS, keys: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Sessions by inactivity gap: the keys, windowStart, windowEnd, count.

    Samples less than a gap apart share a session, so samples are first folded into intervals one
    gap wide; a gap of exactly ``gap_ms`` still joins. windowEnd is the last sample's time.
    """
    folded = (
        samples.groupBy(*keys, floor_to(F.col("timestamp"), gap_ms).alias("interval"))
        .agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"), F.count("*").alias("n"))
        .withColumn("before", F.lag("high").over(per_machine("interval", keys=keys)))
    )
    opens = F.col("before").isNull() | (F.col("low") - F.col("before") > gap_ms)
    return (
        island_starts(folded, "interval", opens, keys)
        .groupBy(*keys, "g")
        .agg(F.min("low").alias("windowStart"), F.max("high").alias("windowEnd"), F.sum("n").alias("count"))
        .select(*keys, "windowStart", "windowEnd", "count")
    )


def latest(samples: DataFrame) -> Column:
    """The newest timestamp as a scalar inside the plan."""
    return samples.agg(F.max("timestamp")).scalar()


def closed_sessions(samples: DataFrame, gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> DataFrame:
    """Sessions no later sample can extend, the rows a stream has emitted by now."""
    return sessions(samples, gap_ms).filter(F.col("windowEnd") + gap_ms <= latest(samples) - grace_ms)


def window_counts(samples: DataFrame, width_ms: int = TUMBLING_MS, slide_ms: int | None = None) -> DataFrame:
    """Counts per tumbling or hopping window: machine_id, windowStart, windowEnd, count.

    Hopping windows are put together from counts per slide, not from copies of the samples.
    """
    slide_ms = slide_ms or width_ms
    if width_ms % slide_ms:
        raise ValueError("the width must be a multiple of the slide")
    step = floor_to(F.col("timestamp"), slide_ms)
    counts = samples.groupBy("machine_id", step.alias("step")).agg(F.count("*").alias("n"))
    start = F.explode(F.sequence(F.col("step") - (width_ms - slide_ms), F.col("step"), F.lit(slide_ms)))
    return (
        counts.select("machine_id", start.alias("windowStart"), "n")
        .groupBy("machine_id", "windowStart")
        .agg(F.sum("n").alias("count"))
        .select("machine_id", "windowStart", (F.col("windowStart") + width_ms).alias("windowEnd"), "count")
    )


def closed_windows(samples: DataFrame, width_ms: int = TUMBLING_MS, slide_ms: int | None = None, grace_ms: int = GRACE_MS) -> DataFrame:
    return window_counts(samples, width_ms, slide_ms).filter(
        F.col("windowEnd") <= latest(samples) - grace_ms
    )


def bounds(samples: DataFrame) -> DataFrame:
    """One row: hour of the first sample and time of the last."""
    return samples.agg(
        floor_to(F.min("timestamp"), HOUR_MS).alias("low"), F.max("timestamp").alias("high")
    )


def machine_ids(samples: DataFrame) -> DataFrame:
    return samples.select("machine_id").distinct()


def bin_spine(samples: DataFrame, width_ms: int = DENSE_MS, as_of_ms: int | None = None) -> DataFrame:
    """Every bin of every machine: machine_id, a, b. The last bin ends at ``as_of_ms`` if given."""
    low = samples.agg(floor_to(F.min("timestamp"), HOUR_MS)).scalar()
    high = latest(samples)
    spine = machine_ids(samples).select(
        "machine_id", F.explode(F.sequence(low, high, F.lit(width_ms))).alias("a")
    )
    end = F.col("a") + width_ms
    if as_of_ms is not None:
        end = F.when(end > high, F.lit(as_of_ms)).otherwise(end)
    return spine.withColumn("b", end)


def bin_ends(samples: DataFrame, width_ms: int = DENSE_MS, as_of_ms: int | None = None) -> DataFrame:
    """The bins alone: a, b. The last ends at ``as_of_ms``, by default the newest sample's time."""
    low = samples.agg(floor_to(F.min("timestamp"), HOUR_MS))
    high = latest(samples)
    as_of = high if as_of_ms is None else F.lit(as_of_ms)
    starts = low.toDF("low").select(F.explode(F.sequence("low", high, F.lit(width_ms))).alias("a"))
    end = F.col("a") + width_ms
    return starts.withColumn("b", F.when(end > high, as_of).otherwise(end))


def _spread(samples: DataFrame, width_ms: int) -> tuple[DataFrame, Column, Column]:
    """Every bin of every machine with the filled bin that brings it and that bin's count; the first bin and the newest step.

    All follows from one count of the samples per machine and step, a step being the longest time that
    divides both bins and hours. Each filled bin brings the empty ones after it, a machine's first also those before.
    """
    step = math.gcd(width_ms, HOUR_MS)
    counts = samples.groupBy("machine_id", floor_to(F.col("timestamp"), step).alias("at")).agg(F.count("*").alias("n"))
    # With the sum it reads what the main branch reads, so that both have one shuffle of counts below them.
    ends = counts.agg(F.struct(F.min("at").alias("first"), F.max("at").alias("last"), F.sum("n").alias("n"))).scalar()
    low, high = floor_to(ends["first"], HOUR_MS), ends["last"]
    bins = counts.groupBy("machine_id", (F.col("at") - F.pmod(F.col("at") - low, F.lit(width_ms))).alias("a")).agg(F.sum("n").alias("n"))
    last = high - F.pmod(high - low, F.lit(width_ms))
    bins = bins.select(
        "*", F.coalesce(F.lead("a").over(per_machine("a")) - width_ms, last).alias("until"),
        F.when(F.lag("a").over(per_machine("a")).isNull(), low).otherwise(F.col("a")).alias("since"),
    )
    spread = bins.select("machine_id", F.col("a").alias("filled"), "n", F.explode(F.sequence("since", "until", F.lit(width_ms))).alias("a"))
    return spread, low, high


def samples_in_bins(samples: DataFrame, width_ms: int = DENSE_MS) -> DataFrame:
    """Every (machine, bin) with the samples inside, one row without a sample for an empty bin.

    The bin follows from the time by division, so this is an equality join. Bins with samples need
    no match: only the empty ones are added, from the counts, so no join moves the samples.
    """
    spread, low, _ = _spread(samples, width_ms)
    at = F.col("timestamp")
    placed = samples.withColumn("a", at - F.pmod(at - low, F.lit(width_ms)))
    placed = placed.withColumn("b", F.col("a") + width_ms)
    empty = spread.filter("a <> filled").select("machine_id", "a", (F.col("a") + width_ms).alias("b"))
    return placed.unionByName(empty, allowMissingColumns=True)


def activity_periods_dense(samples: DataFrame, width_ms: int = DENSE_MS, as_of_ms: int | None = None) -> DataFrame:
    """Samples per machine and bin, empty bins with 0."""
    spread, _, high = _spread(samples, width_ms)
    end = F.col("a") + width_ms
    b = end if as_of_ms is None else F.when(end > high, F.lit(as_of_ms)).otherwise(end)
    return spread.select("machine_id", "a", b.alias("b"), F.when(F.col("a") == F.col("filled"), F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("count"))


def condition_islands(bins: DataFrame, threshold: int = SUFFICIENT) -> DataFrame:
    """Bins with ``cond`` (too few samples) and the run ``r`` of equal cond they belong to."""
    marked = bins.withColumn("cond", F.col("count") < threshold)
    marked = marked.withColumn("pcond", F.lag("cond").over(per_machine("a")))
    opens = F.col("pcond").isNull() | (F.col("cond") != F.col("pcond"))
    return island_starts(marked, "a", opens).withColumnRenamed("g", "r").drop("pcond")


def sample_condition_runs(bins: DataFrame, threshold: int = SUFFICIENT) -> DataFrame:
    return (
        condition_islands(bins, threshold)
        .groupBy("machine_id", "r", "cond")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"))
        .select("machine_id", "a", "b", "cond", (F.col("b") - F.col("a")).alias("diff"))
    )


def sufficient_sample_periods(bins: DataFrame, threshold: int = SUFFICIENT) -> DataFrame:
    return sample_condition_runs(bins, threshold).filter(~F.col("cond"))
