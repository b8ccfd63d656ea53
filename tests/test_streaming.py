"""Streams over several micro-batches against the batch operators of the same name."""

import os
import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import ingest, periods
from millwright.session import new_path
from millwright.sources import tables, topic
from millwright.streaming import counts, sinks
from tests.conftest import SAMPLE, rows

MIN = 60_000
LONG_AFTER = 10**9


def walk(seed, count=240):
    """In-order samples of three machines, the last one long after the others."""
    rng, at, made = random.Random(seed), 0, []
    for offset in range(count):
        at += rng.choice([0, 1000, 30_000, 5 * MIN, 7 * MIN])
        made.append(
            (
                f"m{rng.randrange(3)}", offset, at, 0, rng.choice(["ACTIVE", "READY", "", None]),
                rng.choice([None, rng.randrange(4)]), rng.choice([None, None, f"O{rng.randrange(3)}"]),
            )
        )
    return [*made, ("end", count, at + LONG_AFTER, 0, None, None, None)]


def write_files(folder, made, files, start=0):
    """Rows in order over several files, each a second newer than the one before."""
    import json

    os.makedirs(folder, exist_ok=True)
    size = -(-len(made) // files)
    for i in range(files):
        path = f"{folder}/part-{start + i:03}.json"
        with open(path, "w") as out:
            chunk = made[i * size : (i + 1) * size]
            random.Random(i).shuffle(chunk)
            for row in chunk:
                out.write(json.dumps(dict(zip(SAMPLE.names, row))) + "\n")
        os.utime(path, (1_000_000 + start + i,) * 2)


@pytest.fixture
def streamed(spark):
    def make(made, files=5):
        folder = new_path(spark, "input").removeprefix("file:")
        write_files(folder, made, files)
        return spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).json(folder), spark.createDataFrame(made, SAMPLE)

    return make


def test_window_counts(streamed):
    stream, batch = streamed(walk(1))
    # Rows inside a file are shuffled; the grace covers a file.
    grace = 100_000 * MIN
    assert rows(sinks.run_once(counts.window_counts(stream, grace_ms=grace), "t")) == rows(
        periods.closed_windows(batch, grace_ms=grace)
    )


def test_window_counts_are_complete_once_the_stream_has_moved_on(streamed):
    made = walk(2)
    stream, batch = streamed(made, files=1)
    got = sinks.run_once(counts.window_counts(stream), "t")
    assert rows(got) == rows(periods.closed_windows(batch))
    assert got.agg(F.sum("count")).first()[0] == len(made) - 1


def test_hopping_and_session_counts(streamed):
    stream, batch = streamed(walk(3), files=1)
    assert rows(sinks.run_once(counts.window_counts(stream, 5 * MIN, MIN), "h")) == rows(
        periods.closed_windows(batch, 5 * MIN, MIN)
    )
    assert rows(sinks.run_once(counts.session_counts(stream), "s")) == rows(periods.closed_sessions(batch))


def _at(machine, offset, timestamp):
    return (machine, offset, timestamp, 0, None, None, None)


def test_rows_later_than_the_grace_are_dropped(streamed):
    # A batch is tested against the watermark the batch before it started with.
    times = [0, 10 * MIN, 10 * MIN + 30_000, 30_000, 9 * MIN + 30_000, 60 * MIN, 90 * MIN]
    stream, _ = streamed([_at("m", i, t) for i, t in enumerate(times)], files=len(times))
    got = rows(sinks.run_once(counts.window_counts(stream), "late"), "windowStart", "count")
    assert sorted(got) == [(0, 1), (9 * MIN, 1), (10 * MIN, 2), (60 * MIN, 1)]


def test_a_slow_machine_needs_a_longer_grace(streamed):
    made = [_at("fast", 0, 60 * MIN), _at("fast", 1, 60 * MIN + 1), _at("slow", 2, 0), _at("fast", 3, 200 * MIN)]
    short = rows(sinks.run_once(counts.window_counts(streamed(made, 4)[0]), "short"), "machine_id")
    long = rows(sinks.run_once(counts.window_counts(streamed(made, 4)[0], grace_ms=61 * MIN), "long"), "machine_id")
    assert short == [("fast",)] and long == [("fast",), ("slow",)]


def test_keyed_sink_replaces_a_repeated_batch(streamed, spark):
    made = walk(9)
    copies = made + [(*row[:4], "COPY", *row[5:]) for row in made]
    for keep, expected in (("last", "COPY"), ("first", made[0][4])):
        stream, _ = streamed(copies, files=4)
        path = new_path(spark, "sink")
        for _ in range(2):
            sinks.to_keyed_table(stream.withColumn("arrival", F.when(F.col("execution") == "COPY", 1).otherwise(0)), f"{path}/data", f"{path}/check", keep, once=True).awaitTermination()
        table = tables.read_keyed(spark, f"{path}/data", keep)
        assert table.count() == len(made)
        assert rows(table.filter("offset = 0"), "execution") == [(expected,)]


def test_topic_dump_to_flat_samples(spark):
    records = spark.createDataFrame(
        [("m", '{"values":{"execution":"ACTIVE"},"meta":{"total":3}}', 0, 0), ("m", '{"values":{"exec', 0, 1)],
        "key string, value string, partition int, offset bigint",
    ).withColumn("timestamp", F.timestamp_millis(F.lit(5)))
    path = new_path(spark, "dump")
    records.write.json(path)
    flat = ingest.flatten(ingest.decode(topic.json_stream(spark, path)))
    assert rows(sinks.run_once(flat, "flat"), "machine_id", "offset", "timestamp", "execution", "meta_total") == [
        ("m", 0, 5, "ACTIVE", 3)
    ]
    assert topic.json_batch(spark, path).count() == 2


def test_all_lines_are_written(streamed, spark):
    stream, _ = streamed(walk(10, count=50), files=1)
    records = stream.select(F.col("machine_id").alias("key"), F.col("execution").alias("value"), F.timestamp_millis("timestamp").alias("timestamp"))
    path = new_path(spark, "lines")
    sinks.to_lines(sinks.watch_lines(records), f"{path}/data", f"{path}/check", once=True).awaitTermination()
    assert rows(spark.read.text(f"{path}/data").withColumnRenamed("value", "line")) == rows(sinks.watch_lines(spark.createDataFrame(walk(10, count=50), SAMPLE).select(
        F.col("machine_id").alias("key"), F.col("execution").alias("value"), F.timestamp_millis("timestamp").alias("timestamp"))))


def test_replay_on_a_new_checkpoint_loses_nothing(spark):
    path, shape = new_path(spark, "replay"), "offset bigint, partition int, v string, arrival bigint"
    spark.createDataFrame([(k, 0, "old", 0) for k in range(200)], shape).repartition(2).write.parquet(f"{path}/first")
    spark.createDataFrame([(k, 0, "new", a) for k in range(150, 210) for a in (2, 1)], shape).withColumn("v", F.concat("v", "arrival")).coalesce(1).write.parquet(f"{path}/again")
    for source, check in (("first", "a"), ("first", "a"), ("again", "b")):
        stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{path}/{source}")
        sinks.to_keyed_table(stream, f"{path}/data", f"{path}/{check}", once=True).awaitTermination()
    got = {r.offset: r.v for r in tables.read_keyed(spark, f"{path}/data").collect()}
    assert got == {k: "new2" if k >= 150 else "old" for k in range(210)}
    first = {r.offset: r.v for r in tables.read_keyed(spark, f"{path}/data", "first").collect()}
    assert first == {k: "old" if k < 200 else "new2" for k in range(210)}
    tables.compact(spark, f"{path}/data", f"{path}/folded")
    stream = spark.readStream.schema(shape).parquet(f"{path}/first")
    sinks.to_keyed_table(stream.withColumn("v", F.lit("third")), f"{path}/folded", f"{path}/c", once=True).awaitTermination()
    assert {r.offset: r.v for r in tables.read_keyed(spark, f"{path}/folded").collect()} == {k: "third" if k < 200 else "new2" for k in range(210)}


def test_a_stream_without_arrival_is_refused(streamed, spark):
    stream, _ = streamed(walk(9), files=1)
    with pytest.raises(ValueError):
        sinks.to_keyed_table(stream, "nowhere", "nowhere")


def test_counts_as_topic_records(spark):
    found = spark.createDataFrame([("m", 0, 60, 3)], "machine_id string, windowStart bigint, windowEnd bigint, count bigint")
    assert rows(sinks.keyed_records(found)) == [("m", '{"machine_id":"m","windowStart":0,"windowEnd":60,"count":3}')]
