"""The continuous jobs from a topic dump to every table."""

from pyspark.sql import functions as F


from millwright.operators import changes, ingest, matching, periods
from millwright.plans import live
from millwright.session import new_path
from millwright.sources import tables, topic
from millwright.sources.telemetry import messages_from_events
from millwright.streaming import carried
from tests.conftest import rows


def _finish(queries):
    for query in queries:
        query.awaitTermination()


def test_topic_to_tables(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    messages = messages_from_events(events)
    dump, folder = new_path(spark, "dump"), new_path(spark, "live")
    messages.write.json(dump)
    _finish(live.start_ingest(topic.json_stream(spark, dump), folder, once=True))

    flat = ingest.flatten(ingest.decode(messages))
    assert rows(live.stored(spark, folder, "flat"), *flat.columns) == rows(flat)
    assert rows(live.stored(spark, folder, "undecodable"), "value") == rows(ingest.undecodable(messages), "value")
    assert live.stored(spark, folder, "untimed").count() == 0

    def stream():
        return live.flat_stream(spark, folder)

    _finish(live.start_tables(stream(), folder, once=True))
    _finish(live.start_counts(stream(), folder, once=True))
    _finish(live.start_state(stream(), folder, once=True))

    def result(name):
        found = spark.read.parquet(f"{folder}/{name}/data")
        return found.drop("batch")

    state = changes.execution_events(flat)
    assert rows(tables.read_keyed(spark, f"{folder}/samples/data"), *flat.columns) == rows(flat)
    assert rows(tables.read_keyed(spark, f"{folder}/execution/data"), *state.columns) == rows(state)
    assert rows(result("counts")) == rows(periods.closed_windows(flat))
    assert rows(result("counts-sessions")) == rows(periods.closed_sessions(flat))
    assert rows(result("runs")) == rows(changes.execution_run_duration(flat))
    assert rows(result("parts")) == rows(matching.part_completed_events(flat))
    deduped = changes.dedup_consecutive(state, "execution")
    assert rows(result("tagged")) == rows(matching.execution_with_session(deduped, flat))
    assert rows(carried.live_sessions(result("sessions"))) == rows(periods.sessions(flat))


def test_jobs_from_the_command_line(spark):
    from millwright.plans import run
    from millwright.plans.jobs import executions

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    messages = messages_from_events(events)
    dump, out = new_path(spark, "dump"), new_path(spark, "out")
    messages.write.json(dump)
    flat = ingest.flatten(ingest.decode(messages))
    # A device's own position fields, absent from the stand-in messages.
    table = new_path(spark, "table")
    flat.withColumn("program_path_alt", F.lit(None).cast("string")).write.parquet(table)
    run.run(spark, run.options(["executions", dump, out, "--messages"]))
    assert rows(spark.read.parquet(out)) == rows(executions(flat))
    for job in run.JOBS:
        run.run(spark, run.options([job, table, out, "--machine", "m1", "--as-of-ms", "1706745600000"]))
        assert spark.read.parquet(out).columns
