"""Projections, filters, sorts, limits and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HALF_HOUR, Tables, query
from catalog.joins import in_time, neighbour
from catalog.relations import UNPIVOTED, sql
from millwright.functions import clock, device, text
from millwright.operators import changes, ingest, matching
from millwright.plans import jobs

ET = "AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'"


@query("ts_from_millis_exact", sql('SELECT "offset", make_timestamp("timestamp" * 1000) AS ts FROM samples'))
def ts_from_millis_exact(t: Tables):
    return t.samples.select("offset", clock.exact("timestamp").cast("timestamp_ntz").alias("ts"))


@query("ts_from_millis_trunc", sql('SELECT "offset", make_timestamp("timestamp" // 1000 * 1000000) AS ts FROM samples'))
def ts_from_millis_trunc(t: Tables):
    return t.samples.select("offset", clock.truncated("timestamp").cast("timestamp_ntz").alias("ts"))


_EXECUTION = sql('SELECT machine_id, execution, "timestamp", "offset", "partition" FROM execs')


@query("project_execution", _EXECUTION)
@query("stream_executions_batch", _EXECUTION)
def project_execution(t: Tables):
    return ingest.project_execution(ingest.execution_present(t.samples))


@query("project_part_count", sql('SELECT machine_id, "timestamp", "offset", part_count FROM samples'))
def project_part_count(t: Tables):
    return ingest.project_part_count(t.samples)


@query("project_program", sql("""
    SELECT machine_id, "timestamp", "offset", sha1(program) AS hash, program AS contents
    FROM samples WHERE program IS NOT NULL"""))
def project_program(t: Tables):
    return ingest.project_program(t.samples.filter(F.col("program").isNotNull()))


@query("filter_execution_present", sql("""
    SELECT "offset", execution FROM samples WHERE execution IS NOT NULL AND execution <> ''"""))
def filter_execution_present(t: Tables):
    return ingest.execution_present(t.samples).select("offset", "execution")


@query("filter_program_present", sql('SELECT machine_id, "timestamp", "offset", "partition", hash, contents FROM loads'))
def filter_program_present(t: Tables):
    return matching.programs(t.samples)


@query("filter_part_count_positive", sql('SELECT machine_id, "timestamp", "offset", "partition", part_count FROM parts'))
def filter_part_count_positive(t: Tables):
    return matching.part_counts(t.samples)


@query("filter_active_longer_than", sql("""
    SELECT machine_id, "offset", start, stop, duration FROM spans WHERE execution = 'ACTIVE' AND duration > 600000"""))
def filter_active_longer_than(t: Tables):
    found = changes.second_spans(changes.execution_events(t.samples))
    return changes.active_longer_than(found, 600_000).select("machine_id", "offset", "start", "stop", "duration")


@query("filter_machine", sql("""SELECT machine_id, "offset", "timestamp" FROM samples WHERE machine_id = 'm1'"""))
def filter_machine(t: Tables):
    return t.samples.filter(F.col("machine_id") == "m1").select("machine_id", "offset", "timestamp")


@query("filter_closed", sql("""SELECT machine_id, execution, "offset", start, stop FROM spans"""))
def filter_closed(t: Tables):
    found = changes.second_spans(changes.execution_events(t.samples))
    return found.select("machine_id", "execution", "offset", "start", "stop")


@query("filter_changed", sql('SELECT machine_id, "timestamp", "offset", execution FROM placed_lag WHERE p IS NULL OR execution <> p'))
def filter_changed(t: Tables):
    kept = F.col("p").isNull() | ~F.col("execution").eqNullSafe(F.col("p"))
    return neighbour(t).filter(kept).select("machine_id", "timestamp", "offset", "execution")


@query("filter_increase", sql("""
    SELECT machine_id, "timestamp", "offset", part_count FROM (
      SELECT *, lag(part_count) OVER (PARTITION BY machine_id ORDER BY "timestamp", "offset") AS p FROM parts)
    WHERE part_count > p"""))
def filter_increase(t: Tables):
    paired = in_time(matching.part_counts(t.samples), lag={"p": F.col("part_count")})
    return paired.filter(F.col("part_count") > F.col("p")).select("machine_id", "timestamp", "offset", "part_count")


_UNPIVOT = sql(UNPIVOTED)


@query("unpivot_fields", _UNPIVOT)
@query("filter_value_not_null", _UNPIVOT)
def unpivot_fields(t: Tables):
    return ingest.unpivot_fields(t.samples)


@query("filter_pow2_progress", sql("""
    SELECT machine_id, "offset", "timestamp" FROM samples WHERE "offset" & ("offset" - 1) = 0"""))
def filter_pow2_progress(t: Tables):
    return ingest.power_of_two_offsets(t.samples).select("machine_id", "offset", "timestamp")


@query("drop_null_after_transform", sql("""
    SELECT machine_id, execution, "offset" FROM changes"""))
def drop_null_after_transform(t: Tables):
    kept = changes.dedup_consecutive(changes.execution_events(t.samples), "execution")
    return kept.select("machine_id", "execution", "offset")


_PORT = """CASE event_type WHEN 'error' THEN 'x' || event_id WHEN 'click' THEN '-' || user_id
           WHEN 'view' THEN ' ' || (event_id * 37) || ' ' ELSE CAST(event_id * 13 AS VARCHAR) END"""


@query("port_valid", f"""
    SELECT event_id, CASE WHEN port > 0 AND port < 65535 THEN port END AS port
    FROM (SELECT event_id, TRY_CAST(trim({_PORT}) AS INTEGER) AS port FROM events)""")
def port_valid(t: Tables):
    given = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "event_id"))
        .when(F.col("event_type") == "click", F.concat(F.lit("-"), "user_id"))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), (F.col("event_id") * 37).cast("string"), F.lit(" ")))
        .otherwise((F.col("event_id") * 13).cast("string"))
    )
    return t.events.select("event_id", device.valid_port(given).alias("port"))


@query("rekey", sql("SELECT hash, count(*) AS n, count(DISTINCT machine_id) AS machines FROM loads GROUP BY 1"))
def rekey(t: Tables):
    per_pair = matching.programs(t.samples).groupBy("hash", "machine_id").agg(F.count("*").alias("n"))
    return per_pair.groupBy("hash").agg(F.sum("n").alias("n"), F.count("*").alias("machines"))


@query("order_result", sql('SELECT machine_id, start, "end", execution FROM runs ORDER BY start, machine_id'))
def order_result(t: Tables):
    runs = jobs.executions(t.samples, HALF_HOUR).select("machine_id", "start", "end", "execution")
    return runs.orderBy("start", "machine_id")


@query("limit_n", sql('SELECT machine_id, "offset", start FROM spans ORDER BY start, machine_id, "offset" LIMIT 100'))
def limit_n(t: Tables):
    found = changes.second_spans(changes.execution_events(t.samples)).select("machine_id", "offset", "start")
    return found.orderBy("start", "machine_id", "offset").limit(100)


@query("topk_latest", sql('SELECT machine_id, "offset", "timestamp" FROM samples ORDER BY "timestamp" DESC, "offset" DESC LIMIT 100'))
def topk_latest(t: Tables):
    newest = t.samples.orderBy(F.desc("timestamp"), F.desc("offset")).limit(100)
    return newest.select("machine_id", "offset", "timestamp")


@query("distinct_on_program", sql("SELECT DISTINCT program FROM samples WHERE program IS NOT NULL"))
def distinct_on_program(t: Tables):
    return t.samples.filter(F.col("program").isNotNull()).select("program").distinct()


# ---- scalar functions


@query("to_local_time", sql(f'SELECT "offset", make_timestamp("timestamp" * 1000) {ET} AS local_time FROM samples'))
def to_local_time(t: Tables):
    return t.samples.select("offset", clock.local_time(clock.exact("timestamp")).alias("local_time"))


@query("local_date", sql(f'SELECT "offset", CAST(make_timestamp("timestamp" * 1000) {ET} AS DATE) AS day FROM samples'))
def local_date(t: Tables):
    return t.samples.select("offset", clock.local_date(clock.exact("timestamp")).alias("day"))


@query("time_functions", sql("""
    SELECT "offset",
      "timestamp" - "timestamp" % 3600000 AS hour_start,
      CAST(extract(minute FROM make_timestamp("timestamp" * 1000)) // 5 AS INTEGER) AS slot,
      "timestamp" AS epoch_ms,
      "timestamp" + 300000 AS later,
      least("timestamp", 1704700000000) AS low, greatest("timestamp", 1704700000000) AS high,
      coalesce(meta_status, -1) AS status,
      round("timestamp" / 3600000.0, 6) AS hours,
      strftime(make_timestamp("timestamp" // 1000 * 1000000) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%dT%H:%M:%S') AS iso
    FROM samples"""))
def time_functions(t: Tables):
    ts, mid = F.col("timestamp"), F.lit(1704700000000)
    at = clock.exact("timestamp")
    return t.samples.select(
        "offset",
        F.unix_millis(F.date_trunc("hour", at)).alias("hour_start"),
        F.floor(F.minute(at) / 5).cast("int").alias("slot"),
        F.unix_millis(at).alias("epoch_ms"),
        F.unix_millis(at + F.expr("interval 5 minutes")).alias("later"),
        F.least(ts, mid).alias("low"),
        F.greatest(ts, mid).alias("high"),
        F.coalesce("meta_status", F.lit(-1).cast("bigint")).alias("status"),
        F.round(clock.hours("timestamp"), 6).alias("hours"),
        clock.local_iso(at).alias("iso"),
    )


@query("interval_sum", sql("SELECT machine_id, CAST(sum(duration) AS BIGINT) AS ms FROM spans GROUP BY 1"))
def interval_sum(t: Tables):
    found = changes.second_spans(changes.execution_events(t.samples))
    length = clock.exact("stop") - clock.exact("start")
    total = found.groupBy("machine_id").agg(F.sum(length).alias("d"))
    return total.select("machine_id", F.unix_millis(F.timestamp_millis(F.lit(0)) + F.col("d")).alias("ms"))


@query("text_functions", r"""
    SELECT doc_id, regexp_replace(text, '[\n\r]+', ' ', 'g') AS one_line,
      CAST(length(text) AS INTEGER) AS length, sha1(text) AS hash,
      split_part(text, chr(10), 1) AS first_line FROM documents""")
def text_functions(t: Tables):
    return t.read("documents").select(
        "doc_id",
        text.one_line("text").alias("one_line"),
        F.length("text").alias("length"),
        text.content_hash("text").alias("hash"),
        text.first_line("text").alias("first_line"),
    )


@query("json_encode_array", """
    SELECT vec_id, CAST(to_json(list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS INTEGER))) AS VARCHAR) AS axes
    FROM embeddings""")
def json_encode_array(t: Tables):
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))
    return t.read("embeddings").select("vec_id", F.to_json(whole).alias("axes"))


@query("json_decode", """SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events""")
def json_decode(t: Tables):
    return t.events.select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))


@query("map_lookup_explode", """
    SELECT event_id, 'k' AS "key", CAST(props->>'k' AS BIGINT) AS "value" FROM events""")
def map_lookup_explode(t: Tables):
    return t.events.select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))
