"""The named analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HALF_HOUR, Tables, query
from catalog.relations import UNPIVOTED, sql
from millwright.operators import bins, periods, profile
from millwright.plans import jobs

_THRESHOLD = 10  # samples per half hour that count as enough on the generated events

_SPANS = """
    SELECT machine_id, execution, start, stop,
      make_timestamp(start * 1000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS local_start, duration
    FROM spans WHERE execution = 'ACTIVE' AND duration > 20000 """


@query("active_spans", sql(_SPANS + 'ORDER BY "timestamp", machine_id, "offset" LIMIT 100'))
def active_spans(t: Tables):
    return jobs.active_spans(t.samples)


@query("active_spans_all", sql(_SPANS))
def active_spans_all(t: Tables):
    return jobs.active_spans(t.samples, limit=None)


@query("active_per_machine_day", sql("""
    SELECT machine_id,
      CAST(make_timestamp(start * 1000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS date,
      CAST(sum(duration) AS BIGINT) AS sum
    FROM spans WHERE execution = 'ACTIVE' AND duration > 20000 GROUP BY 1, 2"""))
def active_per_machine_day(t: Tables):
    return jobs.active_per_machine_day(t.samples)


@query("most_recent_activity", sql("""
    SELECT machine_id,
      make_timestamp(start * 1000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS start, duration
    FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY start DESC, "offset" DESC) AS n
          FROM spans WHERE execution = 'ACTIVE' AND duration > 40000) WHERE n = 1"""))
def most_recent_activity(t: Tables):
    return jobs.most_recent_activity(t.samples)


@query("execution_durations", sql("""
    SELECT machine_id,
      make_timestamp("timestamp" // 1000 * 1000000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS local_time,
      execution,
      coalesce(n // 1000 * 1000, (SELECT max("timestamp") FROM samples)) - "timestamp" // 1000 * 1000 AS duration
    FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS n
          FROM (SELECT *, lead(execution) OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS following
                FROM execs) WHERE following <> execution)"""))
def execution_durations(t: Tables):
    return jobs.execution_durations(t.samples)


@query("activity_periods_dense", sql('SELECT machine_id, a, b, "count" FROM dense'))
def activity_periods_dense(t: Tables):
    return periods.activity_periods_dense(t.samples)


@query("sample_condition_runs", sql("SELECT machine_id, a, b, cond, diff FROM condition_runs"))
def sample_condition_runs(t: Tables):
    return periods.sample_condition_runs(periods.activity_periods_dense(t.samples), _THRESHOLD)


@query("sufficient_sample_periods", sql("SELECT machine_id, a, b, cond, diff FROM condition_runs WHERE NOT cond"))
def sufficient_sample_periods(t: Tables):
    return periods.sufficient_sample_periods(periods.activity_periods_dense(t.samples), _THRESHOLD)


_PERIODS = "SELECT machine_id, a, b, duration, CAST(r AS INTEGER) AS r, cnt FROM periods"


@query("activity_periods", sql(_PERIODS))
def activity_periods(t: Tables):
    return periods.activity_periods(t.samples, HALF_HOUR)


@query("activity_periods_5min", sql(_PERIODS, bucket=300_000))
def activity_periods_5min(t: Tables):
    return periods.activity_periods(t.samples)


_RUNS = 'SELECT machine_id, start, "end", duration, execution, CAST(r AS INTEGER) AS r FROM runs'


@query("executions", sql(_RUNS))
def executions(t: Tables):
    return jobs.executions(t.samples, HALF_HOUR)


@query("executions_5min", sql(_RUNS, bucket=300_000))
def executions_5min(t: Tables):
    return jobs.executions(t.samples)


@query("executions_mod", sql(_RUNS))
def executions_mod(t: Tables):
    return jobs.executions_mod(t.samples, HALF_HOUR)


@query("activity_graph", sql(_RUNS))
def activity_graph(t: Tables):
    return jobs.activity_graph(t.samples, HALF_HOUR)


def _distribution(relation: str) -> str:
    return f"""SELECT machine_id, execution, b, CAST(sum(overlap_ms) AS BIGINT) AS sum_ms
               FROM {relation} GROUP BY ALL"""


@query("execution_distribution", sql(_distribution("clipped")))
def execution_distribution(t: Tables):
    return jobs.execution_distribution(t.samples, HALF_HOUR)


@query("execution_distribution_strict", sql(_distribution("strict_clipped")))
def execution_distribution_strict(t: Tables):
    return jobs.execution_distribution(t.samples, HALF_HOUR, strict_edges=True)


_TOTALS = "SELECT machine_id, b, active, stopped, interrupted, ready FROM totals"


@query("execution_distribution_totals", sql(_TOTALS))
def execution_distribution_totals(t: Tables):
    return bins.state_totals(jobs.execution_distribution(t.samples, HALF_HOUR))


@query("execution_distribution_fn", sql(_TOTALS, width=900_000))
def execution_distribution_fn(t: Tables):
    return jobs.execution_distribution_totals(t.samples, HALF_HOUR, 900_000)


@query("execution_distribution_fn_7min", sql(_TOTALS, width=420_000))
def execution_distribution_fn_7min(t: Tables):
    return jobs.execution_distribution_totals(t.samples, HALF_HOUR, 420_000)


@query("execution_distribution_table_fn", sql(_TOTALS, width=420_000))
def execution_distribution_table_fn(t: Tables):
    jobs.create_dist(jobs.executions(t.samples, HALF_HOUR))
    return t.spark.sql("SELECT * FROM dist(INTERVAL 7 MINUTES)")


@query("activity_hours", sql("""
    SELECT machine_id, b, round(active / 3600000.0, 9) AS active, round(stopped / 3600000.0, 9) AS stopped,
      round(interrupted / 3600000.0, 9) AS interrupted, round(ready / 3600000.0, 9) AS ready
    FROM totals""", width=3_600_000))
def activity_hours(t: Tables):
    hours = jobs.activity_hours(t.samples, HALF_HOUR)
    states = ("active", "stopped", "interrupted", "ready")
    return hours.select("machine_id", "b", *[F.round(s, 9).alias(s) for s in states])


@query("machines_list", sql("SELECT DISTINCT machine_id FROM totals", width=3_600_000))
def machines_list(t: Tables):
    return jobs.machines_list(jobs.execution_distribution_totals(t.samples, HALF_HOUR, 3_600_000))


COMPLETED_PARTS = sql(r"""
    SELECT i.machine_id, i."timestamp", i.part_count, l."timestamp" AS program_timestamp,
      regexp_replace(l.program, '[\n\r]+', ' ', 'g') AS program
    FROM increases i ASOF JOIN loads_by_second l ON i.machine_id = l.machine_id AND i."timestamp" > l."timestamp" """)


@query("completed_program_parts", COMPLETED_PARTS)
def completed_program_parts(t: Tables):
    return jobs.completed_program_parts(t.samples)


@query("distinct_programs", sql(r"""
    SELECT DISTINCT regexp_replace(program, '[\n\r]+', ' ', 'g') AS program,
      CAST(length(regexp_replace(program, '[\n\r]+', ' ', 'g')) AS INTEGER) AS length
    FROM samples WHERE program IS NOT NULL"""))
def distinct_programs(t: Tables):
    return jobs.distinct_programs(t.samples)


@query("distinct_programs_texts", r"""
    SELECT DISTINCT regexp_replace(text, '[\n\r]+', ' ', 'g') AS program,
      CAST(length(regexp_replace(text, '[\n\r]+', ' ', 'g')) AS INTEGER) AS length
    FROM documents WHERE text IS NOT NULL""")
def distinct_programs_texts(t: Tables):
    return jobs.distinct_programs(t.read("documents").select(F.col("text").alias("program")))


@query("block_progression", sql(f"""
    SELECT machine_id, "timestamp" // 1000 * 1000 AS "timestamp", "offset", "key", "value"
    FROM ({UNPIVOTED}) WHERE machine_id = 'm3'
    ORDER BY "timestamp" // 1000 DESC, "offset" DESC, "key" LIMIT 100"""))
def block_progression(t: Tables):
    return jobs.block_progression(t.samples, "m3")


@query("last_seen", sql("""
    SELECT machine_id,
      make_timestamp(max("timestamp") // 1000 * 1000000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS seen
    FROM samples GROUP BY machine_id"""))
def last_seen(t: Tables):
    return jobs.last_seen(t.samples)


@query("meta_stats", sql("""
    SELECT 'meta_total' AS meta, round(avg(meta_total), 6) AS avg, min(meta_total) AS min, max(meta_total) AS max,
      round(stddev_samp(meta_total), 6) AS stddev FROM samples
    UNION ALL SELECT 'meta_status', round(avg(meta_status), 6), min(meta_status), max(meta_status),
      round(stddev_samp(meta_status), 6) FROM samples"""))
def meta_stats(t: Tables):
    stats = profile.meta_stats(t.samples)
    return stats.withColumns({"avg": F.round("avg", 6), "stddev": F.round("stddev", 6)})
