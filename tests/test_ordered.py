"""Sliced windows against a loop over the sorted rows, at every depth of slicing."""

import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import ordered
from millwright.operators.ordered import STREAM_ORDER, TIME_ORDER, over_slices, slice_by_offset, slice_by_time
from tests.conftest import rows

HOUR = 3_600_000


def steps():
    return {
        "lag": {"p": F.col("execution")},
        "lead": {"n": F.col("timestamp")},
        "carry": {"c": F.col("program")},
        "carry_before": {"cb": F.col("program")},
        "total": {"s": F.col("part_count")},
        "peak": {"m": F.col("part_count")},
    }


def scattered(seed, machines=3, count=200):
    """Rows with quiet hours, a hot hour, a hot minute, a hot second and a hot millisecond."""
    rng = random.Random(seed)
    spread = (200 * HOUR, HOUR, 60_000, 1000, 1)
    made = []
    for offset in range(count):
        machine = "hot" if rng.random() < 0.6 else f"m{rng.randrange(machines)}"
        made.append(
            (
                machine, offset, 7 * HOUR + rng.randrange(rng.choice(spread)), rng.choice("AB"),
                rng.choice([None, rng.randrange(9)]), rng.choice([None, None, None, f"O{offset}"]),
            )
        )
    return made


def expected(made, order):
    out = []
    for machine in {r[0] for r in made}:
        mine = sorted((r for r in made if r[0] == machine), key=order)
        carried = total = peak = None
        for i, (_, offset, timestamp, execution, part, program) in enumerate(mine):
            before = carried
            carried = program or carried
            if part is not None:
                total = part if total is None else total + part
                peak = part if peak is None else max(peak, part)
            out.append(
                (
                    machine, offset,
                    mine[i - 1][3] if i else None,
                    mine[i + 1][2] if i + 1 < len(mine) else None,
                    carried, before, total, peak,
                )
            )
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [1, 3, 20, 10_000])
def test_time_slices(make_samples, limit):
    made = scattered(limit)
    got = over_slices(slice_by_time(make_samples(made), rows=limit), TIME_ORDER, **steps())
    assert rows(got, "machine_id", "offset", "p", "n", "c", "cb", "s", "m") == expected(
        made, lambda r: (r[2], r[1])
    )


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_offset_slices(make_samples, limit):
    made = scattered(limit + 100)
    got = over_slices(slice_by_offset(make_samples(made), rows=limit), STREAM_ORDER, **steps())
    assert rows(got, "machine_id", "offset", "p", "n", "c", "cb", "s", "m") == expected(made, lambda r: r[1])


@pytest.mark.parametrize("limit", [1, 5, 40])
def test_no_slice_exceeds_the_limit(make_samples, limit):
    sliced = slice_by_time(make_samples(scattered(5)), rows=limit)
    largest = sliced.groupBy("machine_id", *ordered.SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= limit


def test_building_starts_no_job(spark, make_samples):
    made = make_samples(scattered(4))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    over_slices(slice_by_time(made, rows=3), TIME_ORDER, **steps())
    over_slices(slice_by_offset(made, rows=3), STREAM_ORDER, **steps())
    assert list(tracker.getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rows_without_machine_or_time(make_samples):
    made = [(None, 1, 5, "A", 1, "p"), ("m", 2, None, "B", 2, None), ("m", 3, 7 * HOUR, "A", 3, "q"), (None, 4, 9 * HOUR, "B", 4, None)]
    got = over_slices(slice_by_time(make_samples(made), rows=1), TIME_ORDER, **steps())
    assert rows(got, "offset", "p", "c", "s") == [(1, None, "p", 1), (2, None, None, 2), (3, "B", "q", 5), (4, "A", "p", 5)]


def test_floor_to_before_1970(spark):
    got = spark.range(1).select(ordered.floor_to(F.lit(-1), 1000).alias("v")).first()[0]
    assert got == -1000


def test_input_order_does_not_matter(make_samples):
    made = scattered(3)
    shuffled = random.Random(0).sample(made, len(made))
    first = over_slices(slice_by_time(make_samples(made), rows=5), TIME_ORDER, **steps())
    second = over_slices(slice_by_time(make_samples(shuffled), rows=5), TIME_ORDER, **steps())
    assert rows(first.drop(*ordered.SLICE)) == rows(second.drop(*ordered.SLICE))


def test_rows_without_a_time_are_cut_by_offset(spark):
    from millwright.operators.ordered import TIME_ORDER, over_slices, slice_by_time

    rows_ = [("m", None if i % 3 else i * 1000, i, 0) for i in range(90)]
    frame = spark.createDataFrame(rows_, "machine_id string, timestamp bigint, offset bigint, partition int")
    sliced = slice_by_time(frame, rows=10)
    sizes = sliced.filter("timestamp IS NULL").groupBy("_slice", "_part").count()
    assert sizes.count() == 9 and sizes.agg({"count": "max"}).first()[0] <= 10
    got = over_slices(sliced, TIME_ORDER, lag={"before": sliced["offset"]})
    order = sorted(rows_, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    expected = {r[2]: b for r, b in zip(order, [None, *(r[2] for r in order)])}
    assert {r.offset: r.before for r in got.collect()} == expected
