"""As-of, stream-to-table and session matching."""

import pytest
from pyspark.sql import functions as F

from millwright.operators import changes, matching, periods
from tests.conftest import rows

LIMITS = [1, 1_000_000]


@pytest.mark.parametrize("limit", LIMITS)
def test_program_must_start_in_an_earlier_second(make_samples, limit):
    df = make_samples(
        [
            ("m", 0, 1000, None, 1), ("m", 1, 2100, None, None, "P\n\r1"), ("m", 2, 2900, None, 2),
            ("m", 3, 3000, None, 3), ("m", 4, 4000, None, None, "P2"), ("m", 5, 5000, None, 2), ("m", 6, 6000, None, 0),
            ("m", 7, 7000, None, 9), ("n", 8, 9000, None, 1), ("n", 9, 9900, None, 2),
        ]
    )
    got = matching.completed_program_parts(df, limit)
    assert rows(got) == [("m", 3000, 3, 2000, "P 1"), ("m", 7000, 9, 4000, "P2")]


@pytest.mark.parametrize("limit", LIMITS)
def test_stream_match_sees_the_program_of_the_same_record(make_samples, limit):
    df = make_samples(
        [
            ("m", 0, 10, None, 4), ("m", 1, 20, None, 5, "P1"), ("m", 2, 30, None, 5), ("m", 3, 40, None, 3),
            ("m", 4, 50, None, None, "P2"), ("m", 5, 60, None, 0), ("m", 6, 70, None, 3), ("m", 7, 80, None, 4),
        ]
    )
    got = matching.part_completed_events(df, limit)
    assert rows(got, "offset", "part_count", "program", "program_timestamp") == [
        (1, 5, "P1", 20), (3, 3, "P1", 20), (7, 4, "P2", 50),
    ]


@pytest.mark.parametrize("limit", LIMITS)
def test_sessions_are_looked_up(make_samples, spark, limit):
    events = changes.execution_events(make_samples([("m", 0, 5, "A"), ("m", 1, 30, "B"), ("m", 2, 50, "A"), ("n", 3, 5, "A")]))
    held = spark.createDataFrame(
        [("m", 0, 10, 1), ("m", 45, 50, 1)], "machine_id string, windowStart bigint, windowEnd bigint, count bigint"
    )
    containing = matching.session_lookup(events, held, rows=limit)
    assert rows(containing, "machine_id", "timestamp", "session") == [("m", 30, -1), ("m", 5, 0), ("m", 50, 45), ("n", 5, -1)]
    first = matching.session_lookup(events, held, "first")
    assert rows(first, "machine_id", "timestamp", "session") == [("m", 30, 0), ("m", 5, 0), ("m", 50, 0), ("n", 5, -1)]
    with pytest.raises(ValueError):
        matching.session_lookup(events, held, "last")


def test_events_outside_every_period_are_dropped(make_samples, spark):
    events = changes.execution_events(make_samples([("m", 0, 5, "A"), ("m", 1, 10, "A"), ("n", 2, 5, "A")]))
    held = spark.createDataFrame([("m", 0, 10, 1)], "machine_id string, a bigint, b bigint, r int")
    assert rows(changes.in_periods(events, held), "machine_id", "timestamp", "r") == [("m", 5, 1)]


def test_program_tables(make_samples):
    df = make_samples([("m", 0, 1, None, None, "P1"), ("n", 1, 2, None, None, "P1"), ("m", 2, 3, None, None, "P2"), ("m", 3, 4, None, None, "")])
    assert rows(matching.program_table_by_machine(df), "machine_id", "contents") == [("m", "P2"), ("n", "P1")]
    assert rows(matching.program_table_by_hash(df), "machine_id", "contents") == [("m", "P2"), ("n", "P1")]


def test_a_hot_program_is_no_join_key(make_samples):
    made = [("m", 0, 0, None, None, "P")] + [("m", i, i * 1000, None, i) for i in range(1, 200)]
    got = matching.completed_program_parts(make_samples(made), rows=10)
    assert got.count() == 198 and periods.machine_ids(got).count() == 1
    assert got.agg(F.countDistinct("program")).first()[0] == 1
