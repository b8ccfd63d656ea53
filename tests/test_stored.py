"""Keyed tables, evolution, readings, fleet."""

import json

import pytest
from pyspark.sql import functions as F

from millwright.operators import fleet, keyed, readings
from millwright.session import new_path
from millwright.sources import tables
from tests.conftest import rows


def _batch(spark, *made):
    return spark.createDataFrame(list(made), "offset bigint, partition int, v string, arrival bigint")


def test_first_and_last_write(spark):
    batch = _batch(spark, (2, 0, "b", 6), (2, 0, "a", 5), (3, 0, "d", 8), (3, 0, "c", 7), (3, 1, "e", 9)).repartition(5)
    arrival = F.col("arrival")
    assert rows(keyed.keep_first(batch, arrival), "offset", "partition", "v") == [(2, 0, "a"), (3, 0, "c"), (3, 1, "e")]
    assert rows(keyed.keep_last(batch, arrival), "offset", "partition", "v") == [(2, 0, "b"), (3, 0, "d"), (3, 1, "e")]


@pytest.mark.parametrize("keep, expected", [("last", "b"), ("first", "a")])
def test_replayed_batches_change_nothing(spark, keep, expected):
    path = new_path(spark, "keyed")
    first, second = _batch(spark, (1, 0, "a", 1), (2, 0, "x", 2)), _batch(spark, (1, 0, "b", 1))
    tables.write_batch(first, path, 0, keep)
    tables.write_batch(second, path, 1, keep)
    once = rows(tables.read_keyed(spark, path, keep))
    tables.write_batch(second, path, 1, keep)
    assert rows(tables.read_keyed(spark, path, keep)) == once
    assert (1, 0, expected) in once and len(once) == 2
    folded = new_path(spark, "folded")
    tables.compact(spark, path, folded, keep)
    assert rows(tables.read_keyed(spark, folded, keep)) == once


def test_new_columns_appear(spark):
    path = new_path(spark, "wide")
    tables.write_batch(_batch(spark, (1, 0, "a", 1)), path, 0)
    tables.write_batch(_batch(spark, (2, 0, "b", 1)).withColumn("extra", F.lit(9)), path, 1)
    assert rows(tables.read_keyed(spark, path), "offset", "v", "extra") == [(1, "a", None), (2, "b", 9)]


def test_tables_by_name(spark, make_samples):
    df = make_samples([("m", 0, 86_400_000 + 1)])
    tables.create_view(df, "some_samples")
    assert tables.read_table(spark, "some_samples").count() == 1
    assert rows(tables.materialize_samples(df).select(F.col("day").cast("string"))) == [("1970-01-02",)]
    path = new_path(spark, "replaced")
    tables.materialize(spark.range(3), path)
    assert tables.materialize(spark.range(2), path).count() == 2


READINGS = "machine_id string, partition int, offset bigint, mprogram int, program string, part_count bigint, cycle_time bigint"


@pytest.mark.parametrize("limit", [1, 2, 1000])
def test_delta_round_trip(spark, limit):
    made = [
        ("m", 0, 0, 1, "P", 5, 9), ("m", 0, 1, 1, "P", 5, 9), ("n", 0, 2, 1, "P", 5, 9),
        ("m", 0, 3, 2, "Q", 5, 9), ("m", 0, 4, 2, "Q", 6, 8), ("n", 0, 5, 1, "P", 5, 9),
    ]
    dense = spark.createDataFrame(made, READINGS)
    fields = ["mprogram", "program", "part_count", "cycle_time"]
    sparse = readings.delta_encode(dense, fields, limit)
    assert rows(sparse, "offset", *fields) == [
        (0, 1, "P", 5, 9), (1, None, None, None, None), (2, 1, "P", 5, 9),
        (3, 2, "Q", None, None), (4, None, None, 6, 8), (5, None, None, None, None),
    ]
    assert rows(readings.delta_decode(sparse, fields, limit)) == rows(dense)


@pytest.mark.parametrize("limit", [1, 1000])
def test_a_message_can_be_cleared(spark, limit):
    sparse = spark.createDataFrame(
        [("m", 0, 0, 4, "stop"), ("m", 0, 1, None, None), ("m", 0, 2, -1, None), ("m", 0, 3, None, None), ("m", 0, 4, 5, "go")],
        "machine_id string, partition int, offset bigint, message_number int, message_text string",
    )
    full = readings.delta_decode(sparse, ["message_number", "message_text"], limit)
    assert rows(full, "offset", "message_number", "message_text") == [
        (0, 4, "stop"), (1, 4, "stop"), (2, -1, None), (3, -1, None), (4, 5, "go"),
    ]


def test_triggered_fields(spark):
    made = [("m", 0, 0, 1, "P", 5, 1), ("m", 0, 1, 1, "Z", 6, 2), ("m", 0, 2, 2, "Q", 6, 3)]
    got = readings.triggered_fields(spark.createDataFrame(made, READINGS))
    assert rows(got, "offset", "program", "cycle_time") == [(0, "P", 1), (1, None, 2), (2, "Q", None)]


def test_status(spark):
    log = spark.createDataFrame(
        [(1, "m", "STARTING", None, "t1"), (2, "m", "FAILED", "x", "t2"), (3, "n", "STARTED", None, "t3"), (4, "n", "no list names it", None, "t4"), (5, "z", None, None, "t5")],
        "id int, machine_id string, status string, status_message string, ts string",
    )
    known = spark.createDataFrame([("m",), ("z",)], "machine_id string")
    kept = fleet.status_log(log)
    assert rows(kept) == rows(log)
    assert rows(fleet.current_status(kept, known)) == [("m", "FAILED", 2, "t2"), ("z", None, 5, "t5")]


PING = "id int, date string, machine_id string, machine_ip string, machine_port int"
MACHINE = "machine_id string, machine_ip string, machine_port int, modified_at string, created_at string"


def test_registry_accepts_only_the_newest_ping(spark):
    pings = spark.createDataFrame([(1, "d1", "m", "ip1", 1), (2, "d2", "m", "ip2", 2)], PING)
    asked = pings.select("machine_id", "machine_ip", "machine_port")
    accepted = fleet.accepted_requests(asked, pings)
    assert rows(accepted) == [("m", "ip2", 2)]
    now = F.lit("now")
    empty = spark.createDataFrame([], MACHINE)
    assert rows(fleet.registry_upsert(empty, accepted, now)) == [("m", "ip2", 2, None, "now")]
    known = spark.createDataFrame([("m", "ip0", 0, None, "then"), ("n", "ip9", 9, None, "then")], MACHINE)
    assert rows(fleet.registry_upsert(known, accepted, now)) == [
        ("m", "ip2", 2, "now", "then"), ("n", "ip9", 9, None, "then"),
    ]


def test_registry_changes(spark):
    ddl = "machine_id string, machine_ip string, machine_port int"
    old = spark.createDataFrame([("same", "a", 1), ("moved", "a", 1), ("gone", "a", None)], ddl)
    new = spark.createDataFrame([("same", "a", 1), ("moved", "b", 1), ("new", None, 2)], ddl)
    events = {m: json.loads(e) for m, e in rows(fleet.registry_changes(old, new))}
    assert events == {
        "moved": {"machine_id": "moved", "payload": {"machine_id": "moved", "machine_ip": "b", "machine_port": 1}},
        "gone": {"machine_id": "gone", "payload": None},
        "new": {"machine_id": "new", "payload": {"machine_id": "new", "machine_ip": None, "machine_port": 2}},
    }


def test_probe_axes_are_trimmed(spark):
    probes = spark.createDataFrame([([" X", "Y ", "Z"],)], "machine_axes array<string>")
    assert rows(fleet.ping_rows(probes)) == [(["X", "Y", "Z"],)]


def _table(spark, path):
    shape = "offset bigint, partition int, v string, arrival bigint"
    first = spark.createDataFrame([(k, 0, "old", 0) for k in range(50)], shape)
    again = spark.createDataFrame([(k, 0, "new", 0) for k in range(18, 33)], shape)
    tables.write_batch(first, path, 0, run="1", range_offsets=10)
    tables.write_batch(again, path, 1, run="1", range_offsets=10)
    return again.withColumn("v", F.lit("newer"))


def test_a_range_of_offsets_reads_its_own_files(spark):
    path = new_path(spark, "ranges")
    _table(spark, path)
    found = tables.read_keyed(spark, path, offsets=(15, 30), range_offsets=10)
    assert {r.offset: r.v for r in found.collect()} == {k: "new" if k >= 18 else "old" for k in range(15, 30)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(keyed_range" in plan
    assert sorted({f.split("keyed_range=")[1].split("/")[0] for f in found.inputFiles()}) != []
    read = spark.read.option("basePath", path).parquet(path).filter("keyed_range BETWEEN 1 AND 2")
    assert read.select("keyed_range").distinct().count() == 2


def test_compaction_rewrites_only_ranges_of_several_batches(spark):
    path = new_path(spark, "compacted")
    newer = _table(spark, path)

    def files(r):
        stored = spark.read.option("basePath", path).parquet(path).filter(f"keyed_range = {r}")
        return sorted({x[0] for x in stored.select(F.input_file_name()).collect()})

    before = {r: files(r) for r in range(5)}
    assert tables.compact_ranges(spark, path) == [1, 2, 3]
    after = {r: files(r) for r in range(5)}
    assert all(after[r] == before[r] for r in (0, 4)) and all(not set(after[r]) & set(before[r]) for r in (1, 2, 3))
    expected = {k: "new" if 18 <= k < 33 else "old" for k in range(50)}
    assert {r.offset: r.v for r in tables.read_keyed(spark, path).collect()} == expected
    # The stream goes on, and its batch of before is repeated.
    tables.write_batch(newer.withColumn("v", F.lit("new")), path, 1, run="1", range_offsets=10)
    tables.write_batch(newer, path, 2, run="1", range_offsets=10)
    expected = {k: "newer" if 18 <= k < 33 else "old" for k in range(50)}
    assert {r.offset: r.v for r in tables.read_keyed(spark, path).collect()} == expected
    assert tables.compact_ranges(spark, path) == [1, 2, 3] and tables.compact_ranges(spark, path) == []
    assert {r.offset: r.v for r in tables.read_keyed(spark, path).collect()} == expected
    assert {r.offset: r.v for r in tables.read_keyed(spark, path, "first").collect()}[20] == "newer"


def test_files_do_not_grow_with_the_ranges(spark):
    path = new_path(spark, "many")
    first = spark.range(0, 13_000, 1, 4).select(F.col("id").alias("offset"), F.lit(0).alias("partition"), F.lit("old").alias("v"), F.lit(0).cast("bigint").alias("arrival"))
    again = first.where("offset BETWEEN 2045 AND 2055 OR offset BETWEEN 9000 AND 9009").withColumn("v", F.lit("new"))
    tables.write_batch(first, path, 0, run="1", range_offsets=10)
    tables.write_batch(again, path, 1, run="1", range_offsets=10)

    def folders():
        stored = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
        return stored.select("keyed_run", "keyed_batch", "keyed_range").distinct().count()

    def check():
        expected = {k: "new" if 2045 <= k <= 2055 or 9000 <= k <= 9009 else "old" for k in range(13_000)}
        assert {r.offset: r.v for r in tables.read_keyed(spark, path).collect()} == expected
        for low, high in ((2041, 2059), (0, 5), (9005, 9030), (12_990, 14_000), (0, 13_000), (79, 81)):
            found = tables.read_keyed(spark, path, offsets=(low, high), range_offsets=10).collect()
            assert sorted((r.offset, r.v) for r in found) == [(k, expected[k]) for k in range(low, min(high, 13_000))]

    assert folders() < 300  # of 1,300 ranges
    check()
    assert tables.compact_ranges(spark, path) == [200, 896]
    assert folders() < 300 and tables.compact_ranges(spark, path) == []
    check()


def test_rows_without_offset_stay(spark):
    path = new_path(spark, "unnamed")
    tables.write_batch(_batch(spark, (None, 0, "a", 1), (1, 0, "x", 1)), path, 0, range_offsets=10)
    tables.write_batch(_batch(spark, (None, 0, "b", 1), (1, 0, "y", 1)), path, 1, range_offsets=10)
    assert tables.compact_ranges(spark, path) == [0]
    assert sorted((r.offset or -1, r.v) for r in tables.read_keyed(spark, path).collect()) == [(-1, "b"), (1, "y")]
