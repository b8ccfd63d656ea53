"""Joins, aggregations and windows as single operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DEEP_SLICE_ROWS, HALF_HOUR, Tables, query
from catalog.jobs import COMPLETED_PARTS
from catalog.relations import sql
from millwright.functions import clock
from millwright.operators import bins, changes, ingest, keyed, matching, periods, profile
from millwright.operators.ordered import SLICE, TIME_ORDER, over_slices, slice_by_time, unsliced
from millwright.plans import jobs

# ---- joins


@query("join_samples_in_period", sql("""
    SELECT machine_id, a, b, CAST(r AS INTEGER) AS r, "timestamp", "offset", execution FROM placed"""))
def join_samples_in_period(t: Tables):
    placed = changes.in_periods(
        changes.execution_events(t.samples), periods.activity_periods(t.samples, HALF_HOUR)
    )
    return placed.select("machine_id", "a", "b", "r", "timestamp", "offset", "execution")


@query("join_bins_left_range", sql("""
    SELECT s.machine_id, s.a, s.b, t."offset" FROM spine s LEFT JOIN samples t
      ON s.machine_id = t.machine_id AND t."timestamp" BETWEEN s.a AND s.b - 1"""))
def join_bins_left_range(t: Tables):
    return periods.samples_in_bins(t.samples).select("machine_id", "a", "b", "offset")


@query("cross_machines_bins", sql("SELECT machine_id, a, b FROM spine"))
def cross_machines_bins(t: Tables):
    return periods.bin_spine(t.samples)


@query("join_overlap_bins", sql("SELECT machine_id, execution, b, overlap_ms FROM clipped"))
def join_overlap_bins(t: Tables):
    return bins.overlap_bins(jobs.executions(t.samples, HALF_HOUR))


@query("join_overlap_bins_strict", sql("SELECT machine_id, execution, b, overlap_ms FROM strict_clipped"))
def join_overlap_bins_strict(t: Tables):
    return bins.overlap_bins(jobs.executions(t.samples, HALF_HOUR), strict_edges=True)


@query("asof_program", sql("""
    SELECT p.machine_id, p."timestamp", p."offset", p.part_count, l."offset" AS program_offset
    FROM (SELECT *, "timestamp" // 1000 AS s FROM parts) p
    ASOF LEFT JOIN (SELECT machine_id, "timestamp" // 1000 AS s, max("offset") AS "offset" FROM loads GROUP BY ALL) l
      ON p.machine_id = l.machine_id AND p.s > l.s"""))
def asof_program(t: Tables):
    parts = matching.part_counts(t.samples).withColumnRenamed("timestamp", "exact")
    loads = matching.programs(t.samples)
    found = matching.asof_before(
        parts.withColumn("timestamp", clock.to_second("exact")),
        loads.withColumn("timestamp", clock.to_second("timestamp")),
        F.col("offset"),
    )
    return found.select(
        "machine_id", F.col("exact").alias("timestamp"), "offset", "part_count",
        F.col("_matched").alias("program_offset"),
    )


_TABLE_JOIN = sql("""
    SELECT c.machine_id, c."timestamp", c."offset", c.part_count, c."timestamp" AS part_count_timestamp,
      l.contents AS program, l.hash AS program_hash, l."timestamp" AS program_timestamp
    FROM part_changes c ASOF JOIN loads l ON c.machine_id = l.machine_id AND c."offset" >= l."offset" """)


@query("stream_table_join", _TABLE_JOIN)
@query("part_completed_events", _TABLE_JOIN)
def part_completed_events(t: Tables):
    return matching.part_completed_events(t.samples)


_LOOKUP = sql("""
    SELECT c.machine_id, c.execution, c."timestamp", c."offset", c."partition",
      coalesce(s."windowStart", -1) AS session
    FROM changes c LEFT JOIN sessions s ON s.machine_id = c.machine_id
      AND c."timestamp" BETWEEN s."windowStart" AND s."windowEnd" """)


@query("session_lookup", _LOOKUP)
@query("execution_with_session", _LOOKUP)
def execution_with_session(t: Tables):
    changed = changes.dedup_consecutive(changes.execution_events(t.samples), "execution")
    return matching.execution_with_session(changed, t.samples, HALF_HOUR)


@query("session_lookup_first", sql("""
    SELECT c.machine_id, c.execution, c."timestamp", c."offset", c."partition", s.first AS session
    FROM changes c JOIN (SELECT machine_id, min("windowStart") AS first FROM sessions GROUP BY 1) s USING (machine_id)"""))
def session_lookup_first(t: Tables):
    changed = changes.dedup_consecutive(changes.execution_events(t.samples), "execution")
    return matching.execution_with_session(changed, t.samples, HALF_HOUR, "first")


@query("distinct_machine_ids", sql("SELECT DISTINCT machine_id FROM samples"))
def distinct_machine_ids(t: Tables):
    return periods.machine_ids(t.samples)


# ---- aggregations


@query("count_per_bucket", sql("SELECT machine_id, bucket, cnt FROM buckets", bucket=300_000))
def count_per_bucket(t: Tables):
    return periods.count_per_bucket(t.samples)


@query("count_per_bin_spine", sql('SELECT machine_id, a, b, "count" FROM dense'))
def count_per_bin_spine(t: Tables):
    return periods.activity_periods_dense(t.samples)


@query("islands_min_max_sum", sql("SELECT machine_id, a, b, cnt FROM periods"))
def islands_min_max_sum(t: Tables):
    return periods.activity_periods(t.samples, HALF_HOUR).select("machine_id", "a", "b", "cnt")


@query("runs_min_max", sql("SELECT machine_id, a, b, cond FROM condition_runs"))
def runs_min_max(t: Tables):
    runs = periods.sample_condition_runs(periods.activity_periods_dense(t.samples), 10)
    return runs.select("machine_id", "a", "b", "cond")


@query("sum_overlap", sql("""
    SELECT machine_id, execution, b, CAST(sum(overlap_ms) AS BIGINT) AS sum_ms FROM clipped GROUP BY ALL""", width=900_000))
def sum_overlap(t: Tables):
    return bins.execution_distribution(jobs.executions(t.samples, HALF_HOUR), 900_000)


@query("pivot_state_totals", sql("SELECT machine_id, b, active, stopped, interrupted, ready FROM totals", width=3_600_000))
def pivot_state_totals(t: Tables):
    return bins.state_totals(bins.execution_distribution(jobs.executions(t.samples, HALF_HOUR), 3_600_000))


@query("sum_duration_per_day", sql("""
    SELECT machine_id, CAST(make_timestamp(start * 1000) AS DATE) AS date, CAST(sum(duration) AS BIGINT) AS sum
    FROM spans GROUP BY ALL"""))
def sum_duration_per_day(t: Tables):
    found = changes.second_spans(changes.execution_events(t.samples))
    day = clock.local_date(clock.exact("start"), "UTC")
    return found.groupBy("machine_id", day.alias("date")).agg(F.sum("duration").alias("sum"))


@query("global_max_min", sql("""
    SELECT min("timestamp") - min("timestamp") % 3600000 AS low, max("timestamp") AS high FROM samples"""))
def global_max_min(t: Tables):
    return periods.bounds(t.samples)


@query("max_scalar_correlated", sql("""
    SELECT machine_id, "timestamp", "offset", part_count, CAST(nullif((
      SELECT coalesce(sum(n), 0) FROM loads_by_second l
      WHERE l.machine_id = i.machine_id AND l."timestamp" < i."timestamp"), 0) AS BIGINT) AS r
    FROM increases i"""))
def max_scalar_correlated(t: Tables):
    second = clock.to_second("timestamp")
    increases = matching.asof_before(
        matching.part_counts(t.samples).withColumn("timestamp", second),
        _program_ordinals(t),
        F.col("r"),
        lag={"p": F.col("part_count")},
    ).filter(F.col("part_count") > F.col("p"))
    return increases.select("machine_id", "timestamp", "offset", "part_count", F.col("_matched").alias("r"))


@query("aggregate_keep_changed", sql("""
    SELECT machine_id, "timestamp", "offset", part_count FROM (
      SELECT *, lag(part_count) OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS p
      FROM samples WHERE part_count IS NOT NULL) WHERE p IS NULL OR p <> part_count"""))
def aggregate_keep_changed(t: Tables):
    counted = t.samples.filter(F.col("part_count").isNotNull())
    kept = changes.dedup_consecutive(counted, "part_count")
    return kept.select("machine_id", "timestamp", "offset", "part_count")


# ---- windows


def in_time(df, **steps):
    return unsliced(over_slices(slice_by_time(df), TIME_ORDER, **steps))


def neighbour(t: Tables):
    """Events in their period with the event before in the same period."""
    placed = changes.in_periods(
        changes.execution_events(t.samples), periods.activity_periods(t.samples, HALF_HOUR)
    )
    same = F.col("_previous.timestamp") >= F.col("a")
    return placed.withColumn("p", F.when(same, F.col("_previous.execution")))


@query("lag_execution", sql("""
    SELECT machine_id, CAST(r AS INTEGER) AS r, "timestamp", "offset", execution, p FROM placed_lag"""))
def lag_execution(t: Tables):
    return neighbour(t).select("machine_id", "r", "timestamp", "offset", "execution", "p")


@query("lead_ts_period", sql("""
    SELECT machine_id, CAST(r AS INTEGER) AS r, "timestamp", "offset",
      lead("timestamp") OVER (PARTITION BY machine_id, r ORDER BY "timestamp", "offset") AS nxt
    FROM placed"""))
def lead_ts_period(t: Tables):
    placed = neighbour(t).select("machine_id", "r", "timestamp", "offset", "partition", "b", *SLICE)
    followed = over_slices(placed, TIME_ORDER, lead={"n": F.col("timestamp")})
    return followed.select(
        "machine_id", "r", "timestamp", "offset", F.when(F.col("n") < F.col("b"), F.col("n")).alias("nxt")
    )


@query("lead_ts_machine", sql("""
    SELECT machine_id, "timestamp", "offset",
      lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS stop FROM execs"""))
def lead_ts_machine(t: Tables):
    return changes.spans(changes.execution_events(t.samples)).select("machine_id", "timestamp", "offset", "stop")


@query("lead_execution", sql("""
    SELECT machine_id, "timestamp", "offset", execution,
      lead(execution) OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS n FROM execs"""))
def lead_execution(t: Tables):
    followed = in_time(changes.execution_events(t.samples), lead={"n": F.col("execution")})
    return followed.select("machine_id", "timestamp", "offset", "execution", "n")


@query("lag_part_count", sql("""
    SELECT machine_id, "timestamp", "offset", part_count,
      lag(part_count) OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS p FROM parts"""))
def lag_part_count(t: Tables):
    paired = in_time(matching.part_counts(t.samples), lag={"p": F.col("part_count")})
    return paired.select("machine_id", "timestamp", "offset", "part_count", "p")


@query("lag_bucket", sql("""
    SELECT machine_id, bucket, cnt, lag(bucket) OVER (PARTITION BY machine_id ORDER BY bucket) AS previous FROM buckets"""))
def lag_bucket(t: Tables):
    buckets = periods.count_per_bucket(t.samples, HALF_HOUR)
    return buckets.withColumn("previous", F.lag("bucket").over(periods.per_machine("bucket")))


@query("lag_cond", sql("""
    SELECT machine_id, a, cond, lag(cond) OVER (PARTITION BY machine_id ORDER BY a) AS pcond FROM dense_islands"""))
def lag_cond(t: Tables):
    bins_ = periods.activity_periods_dense(t.samples).withColumn("cond", F.col("count") < 10)
    return bins_.select("machine_id", "a", "cond", F.lag("cond").over(periods.per_machine("a")).alias("pcond"))


@query("lead_bin_end", sql("""
    SELECT a, coalesce(lead(a) OVER (ORDER BY a), (SELECT max("timestamp") FROM samples)) AS b FROM series"""))
def lead_bin_end(t: Tables):
    return periods.bin_ends(t.samples)


@query("running_group_id", sql("SELECT machine_id, bucket, CAST(g AS BIGINT) AS g FROM islands"))
def running_group_id(t: Tables):
    return periods.bucket_islands(t.samples, HALF_HOUR).select("machine_id", "bucket", "g")


@query("running_group_id_sliced", sql("""
    SELECT machine_id, "timestamp", "offset",
      CAST(sum(CASE WHEN execution = 'ACTIVE' THEN 1 ELSE 0 END) OVER
        (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS BIGINT) AS g FROM execs"""))
def running_group_id_sliced(t: Tables):
    opened = F.when(F.col("execution") == "ACTIVE", 1).otherwise(0).cast("bigint")
    counted = over_slices(
        slice_by_time(changes.execution_events(t.samples), rows=DEEP_SLICE_ROWS), TIME_ORDER, total={"g": opened}
    )
    return counted.select("machine_id", "timestamp", "offset", "g")


@query("period_ordinal", sql("SELECT machine_id, a, CAST(r AS INTEGER) AS r FROM periods"))
def period_ordinal(t: Tables):
    return periods.activity_periods(t.samples, HALF_HOUR).select("machine_id", "a", "r")


def _program_ordinals(t: Tables):
    loaded = t.samples.filter(F.col("program").isNotNull()).select(
        "machine_id", "partition", "offset", clock.to_second("timestamp").alias("timestamp"), "program"
    )
    return in_time(loaded, total={"r": F.lit(1).cast("bigint")})


@query("program_ordinal", sql("""
    SELECT machine_id, "timestamp" // 1000 * 1000 AS "timestamp", "offset",
      row_number() OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS r
    FROM samples WHERE program IS NOT NULL"""))
def program_ordinal(t: Tables):
    return _program_ordinals(t).select("machine_id", "timestamp", "offset", "r")


# ---- change operators


@query("dedup_consecutive", sql('SELECT machine_id, execution, "timestamp", "offset", "partition" FROM changes'))
def dedup_consecutive(t: Tables):
    return changes.dedup_consecutive(changes.execution_events(t.samples), "execution")


_RUNS = sql("""
    SELECT machine_id, execution, "timestamp" AS start, n AS "end", "offset", "partition", n - "timestamp" AS duration
    FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS n FROM changes)
    WHERE n IS NOT NULL""")


@query("execution_run_duration", _RUNS)
def execution_run_duration(t: Tables):
    return changes.execution_run_duration(t.samples)


@query("execution_run_duration_sliced", _RUNS)
def execution_run_duration_sliced(t: Tables):
    return changes.execution_run_duration(t.samples, rows=DEEP_SLICE_ROWS)


@query("completed_program_parts_sliced", COMPLETED_PARTS)
def completed_program_parts_sliced(t: Tables):
    return jobs.completed_program_parts(t.samples, rows=DEEP_SLICE_ROWS)


@query("part_completed_events_sliced", _TABLE_JOIN)
def part_completed_events_sliced(t: Tables):
    return matching.part_completed_events(t.samples, rows=DEEP_SLICE_ROWS)


@query("execution_with_session_sliced", _LOOKUP)
def execution_with_session_sliced(t: Tables):
    changed = changes.dedup_consecutive(changes.execution_events(t.samples), "execution")
    return matching.execution_with_session(changed, t.samples, HALF_HOUR, rows=DEEP_SLICE_ROWS)


@query("executions_sliced", sql("""
    SELECT machine_id, start, "end", duration, execution, CAST(r AS INTEGER) AS r FROM runs"""))
def executions_sliced(t: Tables):
    return jobs.executions(t.samples, HALF_HOUR, rows=DEEP_SLICE_ROWS)


@query("program_table_by_machine", sql("""
    SELECT machine_id, "timestamp", "offset", hash, contents FROM loads
    QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY "timestamp" DESC, "offset" DESC) = 1"""))
def program_table_by_machine(t: Tables):
    return matching.program_table_by_machine(t.samples)


@query("program_table_by_hash", sql("""
    SELECT machine_id, "timestamp", "offset", hash, contents FROM loads
    QUALIFY row_number() OVER (PARTITION BY hash ORDER BY "timestamp" DESC, "offset" DESC) = 1"""))
def program_table_by_hash(t: Tables):
    return matching.program_table_by_hash(t.samples)


@query("session_counts", sql('SELECT machine_id, "windowStart", "windowEnd", "count" FROM sessions'))
def session_counts(t: Tables):
    return periods.sessions(t.samples, HALF_HOUR)


# ---- profiles


@query("key_distribution", sql('SELECT machine_id, count(*) AS "count" FROM samples GROUP BY 1'))
def key_distribution(t: Tables):
    return profile.key_distribution(t.samples)


_FIELDS = ("execution", "part_count", "program", "sequence", "mprogram", "cprogram", "block", "block_num")


@query("field_presence", sql(" UNION ALL ".join(
    f"""SELECT '{f}' AS "key", count({f}) AS "count",
        CAST(arg_max({f}, {{'t': "timestamp", 'o': "offset"}}) AS VARCHAR) AS example FROM samples"""
    for f in _FIELDS
)))
def field_presence(t: Tables):
    return profile.field_presence(t.samples, _FIELDS)


_SPARSE = ("execution", "part_count", "program", "mprogram", "cprogram", "block", "block_num")


@query("field_presence_none", sql(" UNION ALL ".join(
    f"""SELECT '{f}' AS "key", count({f}) AS "count",
        CAST(arg_max({f}, {{'t': "timestamp", 'o': "offset"}}) AS VARCHAR) AS example FROM samples"""
    for f in _SPARSE
) + f""" UNION ALL SELECT NULL, count(*), NULL FROM samples
        WHERE {' AND '.join(f + ' IS NULL' for f in _SPARSE)}"""))
def field_presence_none(t: Tables):
    return profile.field_presence(t.samples, _SPARSE)


@query("latest_state_per_machine", sql("""
    SELECT machine_id, p AS previous, execution AS current, "timestamp" FROM
      (SELECT *, lag(execution) OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS p FROM execs)
    WHERE p IS NULL OR p <> execution
    QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY "offset" DESC) = 1"""))
def latest_state_per_machine(t: Tables):
    return profile.latest_state_per_machine(t.samples)


@query("execution_counts", sql("""
    SELECT p AS execution, count(*) AS "count", round(avg("timestamp" - pt), 6) AS mean_ms FROM
      (SELECT *, lag(execution) OVER w AS p, lag("timestamp") OVER w AS pt FROM execs
       WINDOW w AS (PARTITION BY machine_id ORDER BY "partition", "offset"))
    WHERE p <> execution GROUP BY p"""))
def execution_counts(t: Tables):
    return profile.execution_counts(t.samples).withColumn("mean_ms", F.round("mean_ms", 6))


@query("execution_counts_first", sql("""
    SELECT execution, count(*) AS "count", round(avg(n - "timestamp"), 6) AS mean_ms
    FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS n FROM changes)
    WHERE n IS NOT NULL GROUP BY execution"""))
def execution_counts_first(t: Tables):
    return profile.execution_counts(t.samples, "first").withColumn("mean_ms", F.round("mean_ms", 6))


@query("out_of_order_check", sql("""
    SELECT machine_id, "partition", "offset", "timestamp", previous FROM (
      SELECT machine_id, "partition", "offset", "timestamp",
        lag("timestamp") OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS previous
      FROM (SELECT * REPLACE (CASE WHEN sequence = 7 THEN "timestamp" - 7200000 ELSE "timestamp" END AS "timestamp") FROM samples))
    WHERE previous > "timestamp" """))
def out_of_order_check(t: Tables):
    late = F.when(F.col("sequence") == 7, F.col("timestamp") - 7_200_000).otherwise(F.col("timestamp"))
    return profile.out_of_order(t.samples.withColumn("timestamp", late))


@query("block_watch", sql("""
    SELECT machine_id, "timestamp", "offset", block FROM samples WHERE block IS NOT NULL AND block <> ''"""))
def block_watch(t: Tables):
    return ingest.executing_blocks(t.samples)


@query("latest_per_machine", sql("""
    SELECT machine_id, start, duration FROM spans WHERE execution = 'ACTIVE' AND duration > 40000
    QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY start DESC, "offset" DESC) = 1"""))
def latest_per_machine(t: Tables):
    found = changes.active_longer_than(
        changes.second_spans(changes.execution_events(t.samples)), jobs.RECENT_MS
    )
    return keyed.latest_per_key(found, "machine_id", F.struct("start", "offset"), ("start", "duration"))
