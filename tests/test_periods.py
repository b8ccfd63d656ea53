"""Periods, sessions, windows, bins."""

from millwright.operators import bins, periods
from tests.conftest import rows

MIN = 60_000


def test_adjacent_buckets_join_and_an_empty_one_breaks(make_samples):
    df = make_samples([("m", 0, 0), ("m", 1, 9 * MIN), ("m", 2, 15 * MIN), ("m", 3, 15 * MIN + 1)])
    assert rows(periods.activity_periods(df), "a", "b", "duration", "r", "cnt") == [
        (0, 10 * MIN, 10 * MIN, 1, 2), (15 * MIN, 20 * MIN, 5 * MIN, 2, 2),
    ]


def test_a_gap_of_exactly_the_limit_joins(make_samples):
    df = make_samples([("m", 0, 0), ("m", 1, 5 * MIN), ("m", 2, 10 * MIN + 1)])
    assert rows(periods.sessions(df)) == [("m", 0, 5 * MIN, 2), ("m", 10 * MIN + 1, 10 * MIN + 1, 1)]


def test_closed_when_the_grace_has_just_passed(make_samples):
    ending = ("n", 9, 2 * MIN)
    assert rows(periods.closed_windows(make_samples([("m", 0, 0), ending]))) == [("m", 0, MIN, 1)]
    early = ("n", 9, 2 * MIN - 1)
    assert rows(periods.closed_windows(make_samples([("m", 0, 0), early]))) == []
    assert rows(periods.closed_sessions(make_samples([("m", 0, 0), ("n", 9, 6 * MIN)]))) == [("m", 0, 0, 1)]
    assert rows(periods.closed_sessions(make_samples([("m", 0, 0), ("n", 9, 6 * MIN - 1)]))) == []


def test_hopping_windows_hold_a_sample_five_times(make_samples):
    df = make_samples([("m", 0, 10 * MIN + 5)])
    got = rows(periods.window_counts(df, 5 * MIN, MIN), "windowStart", "count")
    assert got == [(s * MIN, 1) for s in (6, 7, 8, 9, 10)]


def test_empty_bins_count_zero(make_samples):
    df = make_samples([("m", 0, 5 * MIN), ("m", 1, 70 * MIN), ("n", 2, 10 * MIN)])
    dense = periods.activity_periods_dense(df)
    assert rows(dense, "machine_id", "a", "count") == [
        ("m", 0, 1), ("m", 30 * MIN, 0), ("m", 60 * MIN, 1),
        ("n", 0, 1), ("n", 30 * MIN, 0), ("n", 60 * MIN, 0),
    ]
    runs = periods.sample_condition_runs(dense, 1)
    assert rows(runs, "machine_id", "a", "b", "cond") == [
        ("m", 0, 30 * MIN, False), ("m", 30 * MIN, 60 * MIN, True), ("m", 60 * MIN, 90 * MIN, False),
        ("n", 0, 30 * MIN, False), ("n", 30 * MIN, 90 * MIN, True),
    ]
    assert all(not r[3] for r in rows(periods.sufficient_sample_periods(dense, 1)))


def test_the_last_bin_ends_at_as_of(make_samples):
    df = make_samples([("m", 0, 5 * MIN), ("m", 1, 40 * MIN)])
    assert rows(periods.bin_ends(df, as_of_ms=50 * MIN)) == [(0, 30 * MIN), (30 * MIN, 50 * MIN)]
    assert rows(periods.bin_spine(df, as_of_ms=50 * MIN), "a", "b") == [(0, 30 * MIN), (30 * MIN, 50 * MIN)]


def _runs(spark, *spans):
    return spark.createDataFrame(
        [("m", "ACTIVE", s, e) for s, e in spans], "machine_id string, execution string, start bigint, end bigint"
    )


def test_edges_of_bins(spark):
    five = 5 * MIN
    on_edge = _runs(spark, (five, 2 * five))
    assert rows(bins.overlap_bins(on_edge), "b", "overlap_ms") == [(five, five)]
    assert rows(bins.overlap_bins(on_edge, strict_edges=True)) == []
    across = _runs(spark, (five - 1, 2 * five + 1))
    assert rows(bins.overlap_bins(across), "b", "overlap_ms") == [(0, 1), (five, five), (2 * five, 1)]
    assert rows(bins.overlap_bins(across, strict_edges=True), "b") == [(0,), (five,), (2 * five,)]
    long_edge = _runs(spark, (0, 2 * five))
    assert rows(bins.overlap_bins(long_edge, strict_edges=True), "b") == [(five,)]


def test_empty_runs_in_bins(spark):
    inside, edge = _runs(spark, (7, 7)), _runs(spark, (0, 0))
    assert rows(bins.overlap_bins(inside), "b", "overlap_ms") == [(0, 0)]
    assert rows(bins.overlap_bins(edge)) == []


def test_bins_start_at_the_first_full_hour(spark):
    hour = 60 * MIN
    runs = _runs(spark, (hour + 8 * MIN, hour + 9 * MIN))
    assert rows(bins.overlap_bins(runs, 7 * MIN), "b") == [(hour + 7 * MIN,)]
