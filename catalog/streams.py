"""Streaming queries, run over everything available, and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HALF_HOUR, Tables, query
from catalog.relations import sql
from millwright.operators import changes, ingest, periods, profile
from millwright.schemas import ARRAY_FIELDS, FLAT, META_KEYS, VALUES
from millwright.session import new_path
from millwright.sources import tables, topic
from millwright.sources.telemetry import full_messages_from_events, samples_from_events
from millwright.streaming import carried, counts, sinks, stateful


def _events(t: Tables):
    return topic.table_stream(t.spark, t.sf_dir, "events")


def _samples(t: Tables):
    return samples_from_events(_events(t))


def _bounded_samples(t: Tables):
    """In micro-batches of bounded size."""
    return samples_from_events(topic.table_stream(t.spark, t.sf_dir, "events", topic.BATCH_BYTES))


_TUMBLING = sql("""
    SELECT machine_id, w AS "windowStart", w + 60000 AS "windowEnd", count(*) AS "count"
    FROM (SELECT machine_id, "timestamp" - "timestamp" % 60000 AS w FROM samples)
    GROUP BY machine_id, w HAVING w + 60000 <= (SELECT max("timestamp") FROM samples) - 60000""")


@query("stream_tumbling_counts_final", _TUMBLING)
@query("sink_counts", _TUMBLING)
def stream_tumbling_counts_final(t: Tables):
    return sinks.run_once(counts.window_counts(_samples(t)), "counts")


@query("kstream_count_tumbling", _TUMBLING)
def kstream_count_tumbling(t: Tables):
    return periods.closed_windows(t.samples)


_SESSION = sql("""
    SELECT machine_id, "windowStart", "windowEnd", "count" FROM sessions
    WHERE "windowEnd" + {gap} <= (SELECT max("timestamp") FROM samples) - 60000""")


@query("stream_session_counts_final", _SESSION)
@query("sink_session_counts", _SESSION)
def stream_session_counts_final(t: Tables):
    return sinks.run_once(counts.session_counts(_samples(t), HALF_HOUR), "sessions")


@query("kstream_count_session", _SESSION)
def kstream_count_session(t: Tables):
    return periods.closed_sessions(t.samples, HALF_HOUR)


@query("stream_session_counts_live", sql('SELECT machine_id, "windowStart", "windowEnd", "count" FROM sessions'))
def stream_session_counts_live(t: Tables):
    return carried.live_sessions(carried.run_once(_bounded_samples(t), carried.session_counts_live(HALF_HOUR), "live"))


@query("stream_session_counts_closed", _SESSION)
def stream_session_counts_closed(t: Tables):
    return sinks.run_once(stateful.closed_sessions(_samples(t), HALF_HOUR), "closed")


# Where a partition's own time stands at each of its rows, in a topic whose odd partitions lag an hour behind the others.
_SEEN = """(SELECT *, max("timestamp") OVER (PARTITION BY "partition" ORDER BY "offset") AS seen FROM (
      SELECT * REPLACE ("timestamp" - "partition" % 2 * 3600000 AS "timestamp") FROM samples))"""


def _lagging(t: Tables):
    return _bounded_samples(t).withColumn("timestamp", F.col("timestamp") - F.col("partition") % 2 * 3_600_000)


@query("stream_tumbling_counts_by_partition", sql(f"""
    SELECT machine_id, w AS "windowStart", w + 60000 AS "windowEnd", count(*) AS "count"
    FROM (SELECT *, "timestamp" - "timestamp" % 60000 AS w, max(seen) OVER (PARTITION BY "partition") AS final FROM {_SEEN})
    WHERE w + 120000 > seen GROUP BY machine_id, "partition", w, final HAVING w + 120000 <= final"""))
def stream_tumbling_counts_by_partition(t: Tables):
    return carried.run_once(_lagging(t), carried.window_counts(), "by-partition")


@query("stream_hopping_counts_by_partition", sql(f"""
    SELECT machine_id, w AS "windowStart", w + 300000 AS "windowEnd", count(*) AS "count"
    FROM (SELECT *, unnest(generate_series("timestamp" - "timestamp" % 60000 - 240000, "timestamp" - "timestamp" % 60000, 60000)) AS w,
      max(seen) OVER (PARTITION BY "partition") AS final FROM {_SEEN})
    WHERE w + 360000 > seen GROUP BY machine_id, "partition", w, final HAVING w + 360000 <= final"""))
def stream_hopping_counts_by_partition(t: Tables):
    return carried.run_once(_lagging(t), carried.window_counts(300_000, 60_000), "hopping-by-partition")


@query("stream_session_counts_by_partition", sql(f"""
    SELECT machine_id, min("timestamp") AS "windowStart", max("timestamp") AS "windowEnd", count(*) AS "count"
    FROM (SELECT *, sum(o) OVER (PARTITION BY "partition", machine_id ORDER BY "timestamp", "offset") AS g FROM (
      SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY "partition", machine_id ORDER BY "timestamp", "offset") <= {{gap}} THEN 0 ELSE 1 END AS o
      FROM (SELECT *, max(seen) OVER (PARTITION BY "partition") AS final FROM {_SEEN}) WHERE "timestamp" >= seen - 60000))
    GROUP BY "partition", machine_id, g, final HAVING max("timestamp") + {{gap}} + 60000 < final"""))
def stream_session_counts_by_partition(t: Tables):
    return carried.run_once(_lagging(t), carried.session_counts(HALF_HOUR), "sessions-by-partition")


_HOPPING = sql("""
    SELECT machine_id, w AS "windowStart", w + 300000 AS "windowEnd", count(*) AS "count" FROM (
      SELECT machine_id, unnest(generate_series("timestamp" - "timestamp" % 60000 - 240000,
        "timestamp" - "timestamp" % 60000, 60000)) AS w FROM samples)
    GROUP BY ALL HAVING w + 300000 <= (SELECT max("timestamp") FROM samples) - 60000""")


@query("stream_hopping_counts", _HOPPING)
def stream_hopping_counts(t: Tables):
    return sinks.run_once(counts.window_counts(_samples(t), 300_000, 60_000), "hopping")


@query("hopping_counts_batch", _HOPPING)
def hopping_counts_batch(t: Tables):
    return periods.closed_windows(t.samples, 300_000, 60_000)


_EXECUTION = sql('SELECT machine_id, execution, "timestamp", "offset", "partition" FROM execs')


@query("stream_executions", _EXECUTION)
@query("sink_execution", _EXECUTION)
def stream_executions(t: Tables):
    return sinks.run_once(changes.execution_events(_samples(t)), "executions")


@query("dedup_consecutive_stream", sql('SELECT machine_id, execution, "timestamp", "offset", "partition" FROM changes'))
def dedup_consecutive_stream(t: Tables):
    events = changes.execution_events(_bounded_samples(t))
    return carried.run_once(events, carried.dedup_consecutive(events.columns, "execution", "string"), "dedup")


@query("execution_run_duration_stream", sql("""
    SELECT machine_id, execution, "timestamp" AS start, n AS "end", "offset", "partition", n - "timestamp" AS duration
    FROM (SELECT *, lead("timestamp") OVER (PARTITION BY machine_id ORDER BY "partition", "offset") AS n FROM changes)
    WHERE n IS NOT NULL"""))
def execution_run_duration_stream(t: Tables):
    return carried.run_once(_bounded_samples(t), carried.execution_run_duration(), "runs")


@query("part_completed_events_stream", sql("""
    SELECT c.machine_id, c."timestamp", c."offset", c.part_count, c."timestamp" AS part_count_timestamp,
      l.contents AS program, l.hash AS program_hash, l."timestamp" AS program_timestamp
    FROM part_changes c ASOF JOIN loads l ON c.machine_id = l.machine_id AND c."offset" >= l."offset" """))
def part_completed_events_stream(t: Tables):
    return carried.run_once(_bounded_samples(t), carried.part_completed_events(), "parts")


@query("execution_with_session_stream", sql("""
    SELECT c.machine_id, c.execution, c."timestamp", c."offset", c."partition", s."windowStart" AS session
    FROM changes c JOIN sessions s ON s.machine_id = c.machine_id
      AND c."timestamp" BETWEEN s."windowStart" AND s."windowEnd" """))
def execution_with_session_stream(t: Tables):
    return carried.run_once(_bounded_samples(t), carried.execution_with_session(HALF_HOUR), "tagged")


# ---- sources and sinks

def _full(i: int, name: str, kind: str) -> str:
    """Field ``i`` of the messages that carry every field, as the flat sample has it."""
    there = f'CASE WHEN ("offset" + {i}) % 3 = 0 THEN '
    if name in ("execution", "program"):
        return name
    if name == "axes":
        text = '[{"id":"X1","name":"X","index":1,"suffix":"","divisor":1000,"flag":0,"unit":0,"unith":"mm","decimal":3}]'
        return f"{there}'{text}' END AS axes"
    if name in ARRAY_FIELDS:
        return f"""{there}'[' || CAST("offset" / 4 AS DOUBLE) || ',' || CAST(("offset" % 8) / 2 AS DOUBLE) || ']' END AS "{name}\""""
    if kind == "string":
        return f"""{there}'{name}-' || "offset" % 11 END AS "{name}\""""
    number = f'"offset" * 1000 + {i}' if kind == "bigint" else f'CAST(("offset" * {i + 1}) % 1000 AS INTEGER)'
    return f'{there}{number} END AS "{name}"'


_FLAT = FLAT.names
_VALUES = [_full(i, f.name, f.dataType.simpleString()) for i, f in enumerate(VALUES)]
_META = [f'CASE WHEN ("offset" + {j}) % 4 <> 0 THEN "offset" + {j} END AS meta_{k}' for j, k in enumerate(META_KEYS)]
_DECODED = sql('SELECT machine_id, "offset", "timestamp", "partition", ' + ", ".join([*_VALUES, *_META]) + " FROM samples WHERE execution IS NOT NULL")


@query("flatten_sample", _DECODED)
def flatten_sample(t: Tables):
    return ingest.flatten(ingest.decode(t.full_messages))


@query("flatten_generic", _DECODED)
def flatten_generic(t: Tables):
    return ingest.flatten_generic(ingest.decode(t.full_messages)).select(*_FLAT)


@query("flatten_generic_listed", sql("""
    SELECT machine_id, "offset", execution, meta_total, CAST(NULL AS VARCHAR) AS program_path_alt,
      CAST(NULL AS BIGINT) AS meta_axis FROM samples WHERE execution IS NOT NULL"""))
def flatten_generic_listed(t: Tables):
    listed = ["machine_id", "offset", "execution", "meta_total", "program_path_alt", "meta_axis"]
    return ingest.flatten_generic(ingest.decode(t.messages), listed)


@query("parse_tolerant_json", sql("""
    SELECT machine_id AS "key", "partition", "offset", execution FROM samples WHERE execution IS NOT NULL"""))
def parse_tolerant_json(t: Tables):
    return ingest.decode(t.messages).select("key", "partition", "offset", F.col("values.execution").alias("execution"))


@query("undecodable_records", sql("""
    SELECT machine_id AS "key", "partition", "offset" FROM samples WHERE execution IS NULL"""))
def undecodable_records(t: Tables):
    return ingest.undecodable(t.messages).select("key", "partition", "offset")


@query("meta_averages", sql("""
    SELECT 'total' AS "key", count(meta_total) AS n, CAST(sum(meta_total) AS BIGINT) AS total, round(avg(meta_total), 6) AS mean
    FROM samples WHERE execution IS NOT NULL
    UNION ALL SELECT 'status', count(meta_status), CAST(sum(meta_status) AS BIGINT), round(avg(meta_status), 6)
    FROM samples WHERE execution IS NOT NULL"""))
def meta_averages(t: Tables):
    return profile.meta_averages(ingest.decode(t.messages)).withColumn("mean", F.round("mean", 6))


def _json_topic(t: Tables, messages) -> str:
    """The messages as JSON lines files, as a topic dump holds them."""
    path = new_path(t.spark, "topic")
    messages.write.json(path)
    return path


_READ = sql('SELECT machine_id AS "key", "partition", "offset", "timestamp" AS ms FROM samples')


@query("read_samples_stream", _DECODED)
def read_samples_stream(t: Tables):
    flat = ingest.flatten(ingest.decode(topic.json_stream(t.spark, _json_topic(t, t.full_messages))))
    return sinks.run_once(flat, "flat")


@query("source_from_earliest", _READ)
def source_from_earliest(t: Tables):
    records = topic.json_stream(t.spark, _json_topic(t, t.messages))
    return sinks.run_once(
        records.select("key", "partition", "offset", F.unix_millis("timestamp").alias("ms")), "records"
    )


@query("sink_flat", _DECODED)
def sink_flat(t: Tables):
    return sinks.run_once(ingest.flatten(ingest.decode(full_messages_from_events(_events(t)))), "flat")


def _keyed(t: Tables, stream, keep: str = "last"):
    path = new_path(t.spark, "keyed")
    sinks.to_keyed_table(stream, f"{path}/data", f"{path}/checkpoint", keep, once=True).awaitTermination()
    return tables.read_keyed(t.spark, f"{path}/data", keep)


def _twice(stream):
    """Every record written twice, the second time with a later arrival and other timing."""
    copies = F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    doubled = stream.select("*", copies)
    return doubled.withColumn("meta_total", F.col("meta_total") + F.col("copy")).withColumn(
        "arrival", F.col("offset") * 2 + F.col("copy")
    ).drop("copy")


@query("upsert_samples", sql("""
    SELECT machine_id, "offset", "partition", execution, meta_total + 1 AS meta_total FROM samples"""))
def upsert_samples(t: Tables):
    return _keyed(t, _twice(_samples(t))).select("machine_id", "offset", "partition", "execution", "meta_total")


@query("insert_ignore_dedup", sql("""
    SELECT machine_id, "offset", "partition", execution, meta_total FROM samples"""))
def insert_ignore_dedup(t: Tables):
    return _keyed(t, _twice(_samples(t)), "first").select(
        "machine_id", "offset", "partition", "execution", "meta_total"
    )


@query("upsert_executions", _EXECUTION)
@query("microbatch_write", _EXECUTION)
def upsert_executions(t: Tables):
    # An offset is unique in its partition, so rows of one key do not compete here.
    stored = _keyed(t, changes.execution_events(_samples(t)).withColumn("arrival", F.col("offset")))
    return stored.select("machine_id", "execution", "timestamp", "offset", "partition")


@query("replayed_upsert", sql("""
    SELECT machine_id, "offset", "partition", execution,
      CASE WHEN "timestamp" >= 1705320000000 THEN meta_total + 1000 ELSE meta_total END AS meta_total FROM samples"""))
def replayed_upsert(t: Tables):
    """The table is filled; then the records since noon are read again, corrected, on a new checkpoint."""
    path = new_path(t.spark, "replayed")
    arrived = _samples(t).withColumn("arrival", F.col("offset"))
    sinks.to_keyed_table(arrived, f"{path}/data", f"{path}/first", once=True).awaitTermination()
    again = _samples(t).filter(F.col("timestamp") >= 1705320000000).withColumn("arrival", F.col("offset"))
    corrected = again.withColumn("meta_total", F.col("meta_total") + 1000)
    sinks.to_keyed_table(corrected, f"{path}/data", f"{path}/second", once=True).awaitTermination()
    return tables.read_keyed(t.spark, f"{path}/data").select("machine_id", "offset", "partition", "execution", "meta_total")


_RANGE = 1000


def _corrected(t: Tables) -> str:
    """A table in ranges of offsets, and records since noon written again, corrected."""
    path = new_path(t.spark, "ranges")
    arrived = t.samples.withColumn("arrival", F.col("offset"))
    late = arrived.filter(F.col("timestamp") >= 1705320000000).withColumn("meta_total", F.col("meta_total") + 1000)
    tables.write_batch(arrived, path, 0, range_offsets=_RANGE)
    tables.write_batch(late, path, 1, range_offsets=_RANGE)
    return path


_CORRECTED = """
    SELECT machine_id, "offset", "partition", execution,
      CASE WHEN "timestamp" >= 1705320000000 THEN meta_total + 1000 ELSE meta_total END AS meta_total FROM samples"""


@query("upsert_read_range", sql(_CORRECTED + ' WHERE "offset" >= 400 AND "offset" < 2600'))
def upsert_read_range(t: Tables):
    found = tables.read_keyed(t.spark, _corrected(t), offsets=(400, 2600), range_offsets=_RANGE)
    return found.select("machine_id", "offset", "partition", "execution", "meta_total")


@query("upsert_compacted", sql(_CORRECTED))
def upsert_compacted(t: Tables):
    path = _corrected(t)
    tables.compact_ranges(t.spark, path)
    return tables.read_keyed(t.spark, path).select("machine_id", "offset", "partition", "execution", "meta_total")


@query("schema_evolving_write", sql("""
    SELECT machine_id, "offset", "partition", execution,
      CASE WHEN "timestamp" >= 1705320000000 THEN meta_total END AS meta_total FROM samples"""))
def schema_evolving_write(t: Tables):
    path = new_path(t.spark, "evolving")
    arrived = t.samples.withColumn("arrival", F.col("offset"))
    early = F.col("timestamp") < 1705320000000
    slim = ["machine_id", "offset", "partition", "execution", "arrival"]
    tables.write_batch(arrived.filter(early).select(*slim), path, 0)
    tables.write_batch(arrived.filter(~early).select(*slim, "meta_total"), path, 1)
    return tables.read_keyed(t.spark, path).select("machine_id", "offset", "partition", "execution", "meta_total")


@query("topic_size", sql('SELECT "partition", max("offset") + 1 AS size FROM samples GROUP BY 1'))
def topic_size(t: Tables):
    return profile.topic_size(t.messages)


@query("replay_shift", sql("""
    SELECT s."partition", s."offset" FROM samples s
    JOIN (SELECT "partition", max("offset") AS last FROM samples GROUP BY 1) e USING ("partition")
    WHERE s."offset" > e.last - 1000"""))
def replay_shift(t: Tables):
    return profile.replay_from(t.messages, 1000).select("partition", "offset")


@query("read_table", sql('SELECT machine_id, a, b FROM periods'))
def read_table(t: Tables):
    tables.create_view(periods.activity_periods(t.samples, HALF_HOUR), "activity_periods")
    return tables.read_table(t.spark, "activity_periods").select("machine_id", "a", "b")


@query("create_view_periods", sql('SELECT machine_id, a, b, duration, CAST(r AS INTEGER) AS r, cnt FROM periods'))
def create_view_periods(t: Tables):
    return tables.create_view(periods.activity_periods(t.samples, HALF_HOUR), "activity_periods_alt")


@query("materialize_samples", sql("""
    SELECT machine_id, make_timestamp("timestamp" * 1000) AS ts,
      CAST(make_timestamp("timestamp" * 1000) AS DATE) AS day FROM samples"""))
def materialize_samples(t: Tables):
    stored = tables.materialize_samples(t.samples)
    return stored.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("materialize_machine_counts", sql('SELECT machine_id, a, b, "count" FROM dense'))
def materialize_machine_counts(t: Tables):
    return tables.materialize(periods.activity_periods_dense(t.samples))


_REPAIRED = sql("""
    SELECT "partition", "offset", coalesce("timestamp", seen) AS "timestamp" FROM (
      SELECT "partition", "offset", "timestamp", max("timestamp") OVER (PARTITION BY "partition" ORDER BY "offset") AS seen
      FROM (SELECT "partition", "offset", CASE WHEN sequence <> 7 THEN "timestamp" END AS "timestamp" FROM samples))""")


def _broken(samples):
    return samples.withColumn("timestamp", F.when(F.col("sequence") == 7, -F.col("timestamp")).otherwise(F.col("timestamp")))


@query("event_time_repaired", _REPAIRED)
def event_time_repaired(t: Tables):
    return ingest.repair_event_time(_broken(t.samples)).select("partition", "offset", "timestamp")


@query("event_time_repaired_stream", _REPAIRED)
def event_time_repaired_stream(t: Tables):
    columns = ("partition", "offset", "timestamp")
    return carried.run_once(_broken(_bounded_samples(t)), carried.repaired_event_time(columns), "repaired")


@query("event_time_invalid", sql('SELECT "partition", "offset" FROM samples WHERE sequence = 7'))
def event_time_invalid(t: Tables):
    return ingest.split_by_event_time(_broken(t.samples))[1].select("partition", "offset")


@query("console_watch", sql("""
    SELECT 'CreateTime:' || "timestamp" || chr(9) || machine_id || chr(9) || execution AS line FROM execs"""))
def console_watch(t: Tables):
    events = changes.execution_events(_samples(t))
    records = events.select(
        F.col("machine_id").alias("key"), F.col("execution").alias("value"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )
    return sinks.run_once(sinks.watch_lines(records), "watch")
