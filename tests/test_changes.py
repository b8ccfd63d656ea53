"""Changes, runs and spans at their boundaries."""

import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import bins, changes, periods, profile
from millwright.plans import jobs
from tests.conftest import rows

MIN = 60_000


def test_dedup_passes_nulls_and_first(make_samples):
    df = make_samples([("m", 0, 0, "A"), ("m", 1, 1, None), ("m", 2, 2, "A"), ("m", 3, 3, "B"), ("n", 4, 4, "B")])
    kept = changes.dedup_consecutive(df, "execution")
    assert rows(kept, "offset") == [(0,), (1,), (3,), (4,)]


def test_empty_execution_is_no_event(make_samples):
    df = make_samples([("m", 0, 0, ""), ("m", 1, 1, "READY")])
    assert rows(changes.execution_events(df), "offset") == [(1,)]


def test_run_duration_belongs_to_the_earlier_state(make_samples):
    df = make_samples([("m", 5, 100, "A"), ("m", 6, 150, "A"), ("m", 7, 400, "B"), ("m", 8, 900, "A")])
    got = changes.execution_run_duration(df)
    assert rows(got, "execution", "start", "end", "duration", "offset") == [
        ("A", 100, 400, 300, 5), ("B", 400, 900, 500, 7),
    ]


def test_executions_end_at_the_next_run_or_the_period(make_samples):
    df = make_samples(
        [("m", 0, MIN, "A"), ("m", 1, 2 * MIN, "A"), ("m", 2, 4 * MIN, "B"), ("m", 3, 60 * MIN, "B")]
    )
    got = jobs.executions(df)
    assert rows(got, "execution", "start", "end", "r") == [
        ("A", MIN, 4 * MIN, 1), ("B", 4 * MIN, 5 * MIN, 1), ("B", 60 * MIN, 65 * MIN, 2),
    ]


def test_samples_without_state_extend_the_period(make_samples):
    df = make_samples([("m", 0, 0, "A"), ("m", 1, 5 * MIN), ("m", 2, 10 * MIN), ("m", 3, 14 * MIN, "A")])
    assert rows(jobs.executions(df), "start", "end", "r") == [(0, 15 * MIN, 1)]


def test_same_millisecond_changes_follow_the_offset(make_samples):
    df = make_samples([("m", 2, 1000, "B"), ("m", 1, 1000, "A"), ("m", 3, 2000, "A")])
    assert rows(jobs.executions(df), "execution", "start", "end") == [
        ("A", 1000, 1000), ("A", 2000, 5 * MIN), ("B", 1000, 2000),
    ]


@pytest.mark.parametrize("limit", [3, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_runs_tile_their_periods_and_fill_the_bins(make_samples, seed, limit):
    rng = random.Random(seed)
    made = [
        (f"m{rng.randrange(2)}", i, rng.randrange(48 * 60 * MIN), rng.choice(["ACTIVE", "READY", "STOPPED"]))
        for i in range(300)
    ]
    df = make_samples(made)
    runs = jobs.executions(df, 1_800_000, rows=limit)
    tiled = runs.groupBy("machine_id", "r").agg(
        F.min("start").alias("low"), F.max("end").alias("high"), F.sum("duration").alias("total")
    )
    ends = {(m, r): b for m, r, b in rows(periods.activity_periods(df, 1_800_000), "machine_id", "r", "b")}
    for machine, r, low, high, total in rows(tiled):
        assert total == high - low and high == ends[machine, r]
    for width in (300_000, 420_000):
        spread = bins.execution_distribution(runs, width).groupBy("machine_id", "execution").agg(F.sum("sum_ms").alias("s"))
        whole = runs.groupBy("machine_id", "execution").agg(F.sum("duration").alias("s"))
        assert rows(spread) == rows(whole)


def test_executions_mod_is_executions(make_samples):
    df = make_samples([("m", i, i * 90_000, "AB"[i // 3 % 2]) for i in range(40)])
    assert rows(jobs.executions(df)) == rows(jobs.executions_mod(df))


def test_span_thresholds_use_whole_seconds(make_samples):
    df = make_samples([("m", 0, 900, "ACTIVE"), ("m", 1, 21_100, "READY"), ("m", 2, 30_000, "ACTIVE"), ("m", 3, 50_999, "READY")])
    got = jobs.active_spans(df, zone="UTC")
    assert rows(got, "start", "stop", "duration") == [(0, 21_000, 21_000)]


def test_span_across_midnight_counts_on_its_first_day(make_samples):
    day = 86_400_000
    df = make_samples([("m", 0, day - 60_000, "ACTIVE"), ("m", 1, day + 600_000, "READY")])
    got = rows(jobs.active_per_machine_day(df, zone="UTC"))
    assert [(str(d), s) for _, d, s in got] == [("1970-01-01", 660_000)]


def test_recent_activity_is_measured_across_a_clock_change(make_samples):
    before = 1_710_054_000_000  # 2024-03-10 02:00 New York, when clocks jump to 03:00
    df = make_samples([("m", 0, before - 60_000, "ACTIVE"), ("m", 1, before + 60_000, "READY")])
    got = rows(jobs.most_recent_activity(df))
    assert [(str(s), d) for _, s, d in got] == [("2024-03-10 01:59:00", 120_000)]


def test_execution_durations_keep_the_last_event_of_a_run(make_samples):
    df = make_samples([("m", 0, 1000, "A"), ("m", 1, 5000, "A"), ("m", 2, 9000, "B"), ("m", 3, 12_000, "A"), ("m", 4, 15_000, "A")])
    got = jobs.execution_durations(df, as_of_ms=100_000, zone="UTC")
    assert rows(got, "execution", "duration") == [("A", 4000), ("B", 91_000)]


def test_execution_counts_anchors(make_samples):
    df = make_samples([("m", 0, 0, "A"), ("m", 1, 600, "A"), ("m", 2, 1000, "B"), ("m", 3, 1500, "A")])
    assert rows(profile.execution_counts(df)) == [("A", 1, 400.0), ("B", 1, 500.0)]
    assert rows(profile.execution_counts(df, "first")) == [("A", 1, 1000.0), ("B", 1, 500.0)]
    with pytest.raises(ValueError):
        profile.execution_counts(df, "middle")


def test_latest_state(make_samples):
    df = make_samples([("m", 0, 0, "A"), ("m", 1, 10, "B"), ("m", 2, 20, "B"), ("n", 3, 5, "C")])
    assert rows(profile.latest_state_per_machine(df)) == [("m", "A", "B", 10), ("n", None, "C", 5)]
