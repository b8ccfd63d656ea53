"""The named analyses, each a composition of operators over samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions import clock
from millwright.functions.text import one_line
from millwright.operators import bins, changes, ingest, matching, periods
from millwright.operators.keyed import latest_per_key
from millwright.operators.ordered import TIME_ORDER, floor_to, over_slices, slice_by_time
from millwright.schemas import STATES

# Shortest active span of interest, in ms, and result limits.
SPAN_MS = 20_000
RECENT_MS = 40_000
LIMIT = 100


def active_spans(samples: DataFrame, threshold_ms: int = SPAN_MS, zone: str = clock.PLANT_ZONE, limit: int | None = LIMIT, rows: int | None = None) -> DataFrame:
    """ACTIVE spans longer than the threshold with their local start."""
    found = changes.active_longer_than(
        changes.second_spans(changes.execution_events(samples), rows), threshold_ms
    )
    if limit is not None:
        found = found.orderBy("timestamp", "machine_id", "offset").limit(limit)
    return found.select(
        "machine_id", "execution", "start", "stop",
        clock.local_time(clock.exact("start"), zone).alias("local_start"), "duration",
    )


def active_per_machine_day(samples: DataFrame, threshold_ms: int = SPAN_MS, zone: str = clock.PLANT_ZONE, rows: int | None = None) -> DataFrame:
    """ACTIVE ms per machine and local day; a span counts wholly on the day it starts."""
    found = changes.active_longer_than(
        changes.second_spans(changes.execution_events(samples), rows), threshold_ms
    )
    day = clock.local_date(clock.exact("start"), zone)
    return found.groupBy("machine_id", day.alias("date")).agg(F.sum("duration").alias("sum"))


def most_recent_activity(samples: DataFrame, threshold_ms: int = RECENT_MS, zone: str = clock.PLANT_ZONE, rows: int | None = None) -> DataFrame:
    """Newest ACTIVE span over the threshold of each machine; measured in UTC, shown in local time."""
    found = changes.active_longer_than(
        changes.second_spans(changes.execution_events(samples), rows), threshold_ms
    )
    newest = latest_per_key(found, "machine_id", F.struct("start", "offset"), ("start", "duration"))
    return newest.select(
        "machine_id", clock.local_time(clock.exact("start"), zone).alias("start"), "duration"
    )


def execution_durations(samples: DataFrame, as_of_ms: int | None = None, zone: str = clock.PLANT_ZONE, rows: int | None = None) -> DataFrame:
    """Last event of each finished run with the time to the next such event, ``as_of`` for the last.

    Rows are right as run durations only where every stored event is a change of state;
    ``executions`` gives true run durations.
    """
    events = changes.execution_events(samples)
    as_of = F.lit(as_of_ms) if as_of_ms is not None else periods.latest(samples)
    ending = over_slices(
        slice_by_time(events, rows=rows), TIME_ORDER, lead={"following": F.col("execution")}
    ).filter(F.col("following") != F.col("execution"))
    timed = over_slices(ending, TIME_ORDER, lead={"n": F.col("timestamp")})
    second = clock.to_second("timestamp")
    return timed.select(
        "machine_id",
        clock.local_time(clock.exact(second), zone).alias("local_time"),
        "execution",
        (F.coalesce(clock.to_second("n"), as_of) - second).alias("duration"),
    )


def executions(samples: DataFrame, width_ms: int = periods.BUCKET_MS, rows: int | None = None) -> DataFrame:
    return changes.executions(samples, width_ms, rows)


def executions_mod(samples: DataFrame, width_ms: int = periods.BUCKET_MS, rows: int | None = None) -> DataFrame:
    """The same result, with the events named first."""
    events = changes.execution_events(samples)
    return changes.runs_in_periods(events, periods.activity_periods(samples, width_ms), rows)


def activity_graph(samples: DataFrame, width_ms: int = periods.BUCKET_MS, rows: int | None = None) -> DataFrame:
    """Runs with start, end and duration in epoch ms, as a graph consumes them."""
    return executions(samples, width_ms, rows)


def completed_program_parts(samples: DataFrame, rows: int | None = None) -> DataFrame:
    return matching.completed_program_parts(samples, rows)


def distinct_programs(samples: DataFrame) -> DataFrame:
    """Each program text on one line, once, with its length."""
    return (
        samples.filter(F.col("program").isNotNull())
        .select(one_line("program").alias("program"))
        .distinct()
        .withColumn("length", F.length("program"))
    )


def block_progression(samples: DataFrame, machine_id: str, limit: int | None = LIMIT) -> DataFrame:
    """Latest program-position values of one machine, one row per field."""
    mine = samples.filter(F.col("machine_id") == machine_id).withColumn(
        "timestamp", clock.to_second("timestamp")
    )
    fields = ingest.unpivot_fields(mine).select("machine_id", "timestamp", "offset", "key", "value")
    latest = F.desc("timestamp"), F.desc("offset"), "key"
    return fields if limit is None else fields.orderBy(*latest).limit(limit)


def last_seen(samples: DataFrame, zone: str = clock.PLANT_ZONE) -> DataFrame:
    newest = samples.groupBy("machine_id").agg(F.max("timestamp").alias("t"))
    return newest.select("machine_id", clock.local_time(clock.truncated("t"), zone).alias("seen"))


def execution_distribution(samples: DataFrame, bucket_ms: int = periods.BUCKET_MS, width_ms: int = bins.BIN_MS, strict_edges: bool = False) -> DataFrame:
    return bins.execution_distribution(executions(samples, bucket_ms), width_ms, strict_edges)


def execution_distribution_totals(samples: DataFrame, bucket_ms: int = periods.BUCKET_MS, width_ms: int = bins.BIN_MS, strict_edges: bool = False) -> DataFrame:
    return bins.execution_distribution_totals(executions(samples, bucket_ms), width_ms, strict_edges)


def activity_hours(samples: DataFrame, bucket_ms: int = periods.BUCKET_MS, width_ms: int = clock.HOUR_MS) -> DataFrame:
    return bins.activity_hours(execution_distribution_totals(samples, bucket_ms, width_ms))


def machines_list(result: DataFrame) -> DataFrame:
    return result.select("machine_id").distinct()


DIST = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(width INTERVAL DAY TO SECOND)
RETURNS TABLE (machine_id STRING, b BIGINT, {types})
RETURN SELECT machine_id, b, {sums} FROM (
  SELECT machine_id, execution, b, least(b + w, end) - greatest(b, start) AS ms FROM (
    SELECT machine_id, execution, start, end, w,
      explode(sequence(start - pmod(start - origin, w), end - 1 - pmod(end - 1 - origin, w), w)) AS b
    FROM (SELECT *, CASE WHEN {hour} % w = 0 THEN 0 ELSE first_hour END AS origin FROM (
      SELECT *, unix_millis(TIMESTAMP '1970-01-01 00:00:00Z' + width) AS w FROM {view}))))
GROUP BY machine_id, b"""


def create_dist(runs: DataFrame, name: str = "dist", view: str = "dist_runs") -> None:
    """Register the table function ``name(width)``: the state totals of ``runs`` in bins of any width, for ``SELECT`` and ``LATERAL`` joins.

    Equal to ``execution_distribution_totals`` of the same runs; a run names its bins, so bins are not joined.
    """
    first = runs.agg(floor_to(F.min("start"), clock.HOUR_MS)).scalar()
    runs.filter(F.col("start") < F.col("end")).withColumn("first_hour", first).createOrReplaceTempView(view)
    states = [s.lower() for s in STATES]
    sums = ", ".join(f"sum(CASE WHEN execution = '{s}' THEN ms ELSE 0 END) AS {s.lower()}" for s in STATES)
    runs.sparkSession.sql(DIST.format(name=name, view=view, hour=clock.HOUR_MS, sums=sums, types=", ".join(f"{s} BIGINT" for s in states)))
