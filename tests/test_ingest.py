"""Decoding, flattening, field operators."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.operators import ingest, profile
from millwright.schemas import EXECUTION, FLAT, LEGACY_TEXT, META_KEYS, TOPIC_RECORD, VALUE_FIELDS
from tests.conftest import rows

FULL = {
    "values": {
        "execution": "ACTIVE", "part_count": 7, "axes": [
            {"id": "X", "name": "X1", "index": 0, "suffix": "", "divisor": 1000, "flag": 1, "unit": 0, "unith": "mm", "decimal": 3}
        ],
        "actual": [1.5, 2.0], "load": [0.25], "cycle_time": 99, "unheard_of": 1,
    },
    "meta": {"status": 12, "cycle_time": 5, "total": 40, "axis": 3},
}
VALUES = [
    json.dumps(FULL),
    '{"values": {"sequence": 3, "actual": []}, "meta": {}}',
    '{"values": {}, "meta": {"total": 1}}',
    '{"values": {"execution": "ACT',
    '{"meta": {"total": 1}}',
    "not json",
    '{"values": {"message_number": -1, "message_text": null, "execution": ""}, "meta": {"message": 2}}',
]


@pytest.fixture
def records(spark):
    at = datetime(2024, 1, 1, 0, 0, 0, 123000)
    return spark.createDataFrame([("m", v, 0, i, at) for i, v in enumerate(VALUES)], TOPIC_RECORD)


def test_undecodable_records_are_skipped(records):
    assert rows(ingest.decode(records), "offset") == [(0,), (1,), (2,), (6,)]
    assert rows(ingest.undecodable(records), "offset") == [(3,), (4,), (5,)]


def test_flat_schema(records):
    flat = ingest.flatten(ingest.decode(records))
    assert flat.columns == FLAT.names
    assert [f.dataType for f in flat.schema] == [f.dataType for f in FLAT]
    assert len(VALUE_FIELDS) == 45 and len(META_KEYS) == 12


def test_flat_values(records):
    flat = {r["offset"]: r for r in ingest.flatten(ingest.decode(records)).collect()}
    first = flat[0]
    assert first["machine_id"] == "m" and first["timestamp"] % 1000 == 123
    assert first["actual"] == "[1.5,2.0]" and first["load"] == "[0.25]"
    assert json.loads(first["axes"])[0]["divisor"] == 1000
    # A timing never lands in the value field of the same name.
    assert (first["cycle_time"], first["meta_cycle_time"]) == (99, 5)
    assert flat[1]["actual"] is None and flat[1]["sequence"] == 3
    assert flat[2]["meta_total"] == 1 and flat[2]["execution"] is None
    assert flat[6]["message_text"] is None and flat[6]["message_number"] == -1


def test_generic_flattening_follows_the_list(records):
    decoded = ingest.decode(records)
    assert ingest.flatten_generic(decoded).columns == [*FLAT.names, *LEGACY_TEXT]
    listed = ingest.flatten_generic(decoded, ["offset", "meta_axis", "actual", "gone"]).filter("offset = 0")
    assert rows(listed) == [(0, 3, "[1.5,2.0]", None)]


def test_meta_averages(records):
    got = profile.meta_averages(ingest.decode(records))
    assert ("total", 2, 41, 20.5) in rows(got)


def test_field_presence_counts_empty_samples(make_samples):
    df = make_samples([("m", 0, 0, "A"), ("m", 1, 1), ("m", 2, 2, "B", 4)])
    got = profile.field_presence(df, ["execution", "part_count", "program"])
    assert rows(got) == [("execution", 2, "B"), ("part_count", 1, "4"), (None, 1, None)]


def test_powers_of_two(spark):
    df = spark.range(20).withColumnRenamed("id", "offset")
    assert rows(ingest.power_of_two_offsets(df)) == [(0,), (1,), (16,), (2,), (4,), (8,)]


def test_out_of_order(make_samples):
    df = make_samples([("m", 0, 10), ("m", 1, 9), ("m", 2, 9), ("n", 3, 1), ("m", 4, 12)])
    assert rows(profile.out_of_order(df), "offset", "previous") == [(1, 10)]
    assert rows(profile.out_of_order(df, rows=1), "offset", "previous") == [(1, 10)]


@pytest.mark.parametrize("limit", [1, 1000])
def test_invalid_times(make_samples, limit):
    df = make_samples([("m", 0, -5), ("m", 1, 70), ("n", 2, -1), ("m", 3, 60), ("m", 4, -1)])
    assert rows(ingest.repair_event_time(df, limit), "offset", "timestamp") == [(0, None), (1, 70), (2, 70), (3, 60), (4, 70)]
    valid, invalid = ingest.split_by_event_time(df)
    assert rows(valid, "offset") == [(1,), (3,)] and rows(invalid, "offset") == [(0,), (2,), (4,)]


def test_replay(make_samples):
    df = make_samples([("m", i, i) for i in range(10)])
    assert rows(profile.topic_size(df)) == [(0, 10)]
    assert rows(profile.replay_from(df, 3), "offset") == [(7,), (8,), (9,)]
    assert json.loads(profile.replay_offsets(df, "input", 3)) == {"input": {"0": 7}}
    assert json.loads(profile.replay_offsets(df, "input", 30)) == {"input": {"0": 0}}
