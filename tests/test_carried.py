"""Streams over slices, cut into micro-batches in several ways, against the batch operators."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millwright.operators import changes, fleet, ingest, matching, periods, readings
from millwright.operators.ordered import SLICE_ROWS_SETTING
from millwright.session import new_path
from millwright.streaming import carried, sinks, stateful
from tests.conftest import SAMPLE, rows
from tests.test_streaming import MIN, _at, walk

EVENT = ["machine_id", "execution", "timestamp", "offset", "partition"]


@pytest.fixture(autouse=True)
def small_slices(spark):
    spark.conf.set(SLICE_ROWS_SETTING, "20")
    yield
    spark.conf.unset(SLICE_ROWS_SETTING)


def cuts(made, pieces, seed=0):
    """The rows in order as ``pieces`` batches of uneven size, each shuffled."""
    rng = random.Random(seed)
    at = sorted(rng.sample(range(1, len(made)), pieces - 1))
    parts = [made[a:b] for a, b in zip([0, *at], [*at, len(made)])]
    for part in parts:
        rng.shuffle(part)
    return parts


def worked(spark, parts, step, schema=SAMPLE, prepare=lambda df: df):
    """What the step writes over the batches, each worked twice, as after a failure."""
    folder = new_path(spark, "cut")
    for number, part in enumerate(parts):
        for _ in range(2 if number == 1 else 1):
            carried.run_batch(prepare(spark.createDataFrame(part, schema)), number, folder, step)
    return carried.written(spark, folder), folder


def test_changes_and_runs(spark, pieces=3):
    made = walk(4)
    batch = spark.createDataFrame(made, SAMPLE)
    parts, events = cuts(made, pieces), changes.execution_events(batch)
    deduped = changes.dedup_consecutive(events, "execution")
    got, _ = worked(spark, parts, carried.dedup_consecutive(EVENT, "execution", "string"), prepare=changes.execution_events)
    assert rows(got) == rows(deduped)
    assert rows(worked(spark, parts, carried.execution_run_duration())[0]) == rows(changes.execution_run_duration(batch))
    assert rows(worked(spark, parts, carried.part_completed_events())[0]) == rows(matching.part_completed_events(batch))
    assert rows(worked(spark, parts, carried.execution_with_session())[0]) == rows(matching.execution_with_session(deduped, batch))


def test_numbers_beyond_doubles_and_nulls(spark):
    big = 2**53
    made = [("m", i, i, 0, None, v, None) for i, v in enumerate([big, None, big + 1, big + 1, None, big])]
    columns = [*SAMPLE.names[:4], "part_count"]
    got, _ = worked(spark, [made[:2], made[2:5], made[5:]], carried.dedup_consecutive(columns, "part_count", "bigint"))
    assert rows(got, "offset", "part_count") == rows(changes.dedup_consecutive(spark.createDataFrame(made, SAMPLE), "part_count"), "offset", "part_count")


def test_passed_offsets_go_aside(spark):
    first = [_at("m", i, i) for i in (3, 4, 5)]
    again = [_at("m", 4, 4), _at("m", 6, 6), _at("n", 1, 1)]
    _, folder = worked(spark, [first, again], carried.repaired_event_time(["machine_id", "offset"]))
    assert rows(carried.written(spark, folder)) == [("m", 3), ("m", 4), ("m", 5), ("m", 6)]
    assert rows(carried.written(spark, folder, "aside")) == [("m", 4), ("n", 1)]


def test_a_hot_machine_is_cut_into_many_tasks(spark):
    """The widest task of the ordered pass holds a slice, not the machine."""
    made = [("hot", i, i * 1000, 0, "ACTIVE" if i % 3 else "READY", None, None) for i in range(2000)]
    placed = carried.sliced_after(spark.createDataFrame(made, SAMPLE), spark.createDataFrame([("hot", "READY")], "machine_id string, execution string"))
    sizes = placed.groupBy("machine_id", "_slice", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] == 20 and sizes.count() == 101
    plan = changes.changes_only(placed, "execution")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_live_session_counts(spark, pieces=4):
    made = walk(7)
    updates, _ = worked(spark, cuts(made, pieces), carried.session_counts_live())
    assert rows(carried.live_sessions(updates)) == rows(periods.sessions(spark.createDataFrame(made, SAMPLE)))


def test_late_rows_extend_and_join_sessions(spark):
    gap, grace = 300_000, 60 * MIN
    times = [[600_000, 1_600_000], [1_000_000, 590_000], [1_300_000], [50_000_000], [49_990_000, 2_000_000]]
    made = [[_at("m", 10 * i + k, t)] for i, batch in enumerate(times) for k, t in enumerate(batch)]
    updates, _ = worked(spark, made, carried.session_counts_live(gap, grace))
    assert sorted(rows(carried.live_sessions(updates))) == [("m", 590_000, 600_000, 2), ("m", 1_000_000, 1_600_000, 3), ("m", 49_990_000, 50_000_000, 2)]
    assert rows(updates.filter("late"), "windowStart") == [(2_000_000,)]
    updates, _ = worked(spark, [[_at("m", i, t)] for i, t in enumerate([0, 500_000, 250_000])], carried.session_counts_live(gap, grace))
    assert rows(carried.live_sessions(updates)) == [("m", 0, 500_000, 3)]
    assert rows(updates.filter("count IS NULL"), "windowStart") == [(500_000,)]


def lagging(count=300):
    """Two partitions, the second an hour behind, with some rows out of time order and some late."""
    rng, made, at = random.Random(5), [], 0
    for offset in range(count):
        at += rng.choice([0, 5_000, 40_000, 6 * MIN])
        late = rng.choice([0, 0, 0, 30_000, 3 * MIN])
        made.append((f"m{offset % 2}", offset, max(0, 60 * MIN + at - late - offset % 2 * 60 * MIN), offset % 2, None, None, None))
    return made


def plain_windows(made, width, slide, grace):
    seen, counted = {}, {}
    for machine, _, ts, partition, *_ in made:
        seen[partition] = max(seen.get(partition, 0), ts)
        for start in range(ts - ts % slide - width + slide, ts - ts % slide + 1, slide):
            if start + width + grace > seen[partition]:
                counted[machine, start, partition] = counted.get((machine, start, partition), 0) + 1
    return sorted(((m, s, s + width, n) for (m, s, p), n in counted.items() if s + width + grace <= seen[p]), key=repr)


@pytest.mark.parametrize(("pieces", "width", "slide"), [(1, MIN, MIN), (3, 5 * MIN, MIN)])
def test_windows_follow_their_partitions_time(spark, pieces, width, slide):
    made = lagging()
    expected = plain_windows(made, width, slide, MIN)
    assert len({m for m, *_ in expected}) == 2
    assert rows(worked(spark, cuts(made, pieces), carried.window_counts(width, slide))[0]) == expected


def test_sessions_follow_their_partitions_time(spark):
    made, gap, grace = lagging(), 5 * MIN, MIN
    seen, kept = {}, {}
    for machine, _, ts, partition, *_ in made:
        seen[partition] = max(seen.get(partition, 0), ts)
        if ts >= seen[partition] - grace:
            kept.setdefault((machine, partition), []).append(ts)
    expected = []
    for (machine, partition), times in kept.items():
        folded = []
        for ts in sorted(times):
            if folded and ts - folded[-1][1] <= gap:
                folded[-1] = [folded[-1][0], ts, folded[-1][2] + 1]
            else:
                folded.append([ts, ts, 1])
        expected += [(machine, *s) for s in folded if s[1] + gap + grace < seen[partition]]
    got, folder = worked(spark, cuts(made, 3), carried.session_counts(gap, grace))
    assert rows(got) == sorted(expected, key=repr)
    assert carried.written(spark, folder, "aside").count() == len(made) - sum(map(len, kept.values()))


def test_repaired_event_time(spark):
    made = [(*r[:2], -r[2] if i % 4 == 1 else None if i % 9 == 5 else r[2], *r[3:]) for i, r in enumerate(lagging(120))]
    batch = ingest.repair_event_time(spark.createDataFrame(made, SAMPLE))
    got, _ = worked(spark, cuts(made, 4), carried.repaired_event_time(SAMPLE.names))
    assert rows(got) == rows(batch, *SAMPLE.names)


def test_old_state_is_removed_and_a_silent_partition_keeps_one_row(spark):
    made = lagging()
    _, folder = worked(spark, cuts(made, 4), carried.window_counts())
    path = folder.removeprefix("file:")
    assert sorted(d for d in os.listdir(f"{path}/state-open") if d.startswith("batch")) == ["batch=2", "batch=3"]
    assert spark.read.parquet(f"{folder}/state-clock/batch=3").count() == 2


def files(folder, parts):
    os.makedirs(folder, exist_ok=True)
    for i, part in enumerate(parts):
        with open(f"{folder}/{i:03}.json", "w") as out:
            out.writelines(json.dumps(dict(zip(SAMPLE.names, r))) + "\n" for r in part)
        os.utime(f"{folder}/{i:03}.json", (1_000_000 + i,) * 2)


def test_as_a_stream_with_a_restart(spark):
    made, folder, out = walk(8), new_path(spark, "in").removeprefix("file:"), new_path(spark, "out")
    parts = cuts(made, 4)
    for upto in (2, 4):
        files(folder, parts[:upto])
        stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).json(folder)
        carried.start(stream, out, carried.execution_run_duration(), once=True).awaitTermination()
    assert rows(carried.written(spark, out)) == rows(changes.execution_run_duration(spark.createDataFrame(made, SAMPLE)))


def test_sessions_closed_by_timers(spark):
    made, folder = walk(3), new_path(spark, "in").removeprefix("file:")
    files(folder, [made[:100], made[100:180], made[180:]])
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).json(folder)
    got = sinks.run_once(stateful.closed_sessions(stream), "timers")
    assert rows(got) == rows(periods.closed_sessions(spark.createDataFrame(made, SAMPLE)))


def test_a_session_closes_exactly_when_the_batch_operator_says(spark):
    for last in (360_000 + 4 * MIN + 59_999, 360_000 + 5 * MIN, 360_000 + 6 * MIN, 360_000 + 6 * MIN + 1):
        made, folder = [_at("m", 0, 0), _at("m", 1, 60_000), _at("n", 2, last)], new_path(spark, "in").removeprefix("file:")
        files(folder, [made])
        stream = spark.readStream.schema(SAMPLE).json(folder)
        got = rows(sinks.run_once(stateful.closed_sessions(stream), "edge"))
        assert got == rows(periods.closed_sessions(spark.createDataFrame(made, SAMPLE))), last


def test_silent_machines_leave_no_state(spark):
    made, folder, path = walk(3, 60), new_path(spark, "in").removeprefix("file:"), new_path(spark, "state")
    files(folder, [made])
    stream = spark.readStream.schema(SAMPLE).json(folder)
    sinks.to_files(stateful.closed_sessions(stream), f"{path}/data", f"{path}/checkpoint", once=True).awaitTermination()
    state = spark.read.format("statestore").option("stateVarName", "open").load(f"{path}/checkpoint")
    assert [r.key.machine_id for r in state.select("key").collect()] == ["end"]


def test_readings_by_delta(spark):
    rng = random.Random(6)
    shape = "machine_id string, partition int, offset bigint, cprogram int, message_text string, message_number int, program_name string"
    dense = [(f"m{i % 2}", i % 2, i, rng.randrange(2), rng.choice(["a", "b"]), rng.choice([1, -1]), rng.choice(["x", "y"])) for i in range(60)]
    frame, fields = spark.createDataFrame(dense, shape), ("cprogram", "message_text", "message_number")
    parts, schema = cuts(dense, 3), frame.schema
    assert rows(worked(spark, parts, carried.delta_encode(schema, fields), shape)[0]) == rows(readings.delta_encode(frame, fields))
    assert rows(worked(spark, parts, carried.triggered_fields(schema), shape)[0]) == rows(readings.triggered_fields(frame))
    sparse = [(*r[:3], *(v if rng.random() < 0.4 else None for v in r[3:])) for r in dense]
    got, folder = worked(spark, cuts(sparse, 3), carried.delta_decode(schema, fields), shape)
    assert rows(got) == rows(readings.delta_decode(spark.createDataFrame(sparse, shape), fields))
    assert carried.kept(spark, folder, "last").count() == 2  # a row a machine, a column a field


def test_current_status_in_any_order_of_arrival(spark):
    shape = "id bigint, machine_id string, status string, status_message string, ts timestamp_ntz"
    rng = random.Random(7)
    log = [(i, f"m{rng.randrange(5)}", rng.choice(["A", "B", None]), None, None) for i in range(40)]
    frame, known = spark.createDataFrame(log, shape), spark.createDataFrame([("m0",), ("m1",), ("m9",)], "machine_id string")
    rng.shuffle(log)
    updates, folder = worked(spark, cuts(log, 4), carried.current_status(frame.schema), shape)
    now = carried.kept(spark, folder, "last")
    assert rows(fleet.current_status(now, known)) == rows(fleet.current_status(frame, known))
    newest = updates.groupBy("machine_id").agg(F.max_by("id", "update").alias("id"))
    assert rows(newest) == rows(now, "machine_id", "id")


@pytest.mark.parametrize("pieces", [1, 5])
def test_registry_changes_of_three_snapshots(spark, pieces):
    shape = "machine_id string, machine_ip string, machine_port int"
    snapshots = [
        [("a", "1", 1), ("b", "2", None), ("c", "3", 3)],
        [("a", "1", 1), ("b", "2", 2), ("d", "4", 4)],
        [("a", None, 1), ("c", "3", 3), ("d", "4", 4)],
    ]
    frames = [spark.createDataFrame(s, shape) for s in ([], *snapshots)]
    expected = []
    for number, (old, new) in enumerate(zip(frames, frames[1:]), 1):
        expected += [(number, *r) for r in rows(fleet.registry_changes(old, new))]
    made = [(n, False, *r) for n, s in enumerate(snapshots, 1) for r in s]
    made += [(n, True, None, None, None) for n in (1, 2, 3)]  # marks come last
    made = sorted(made, key=lambda r: (r[0], r[1]))
    # A batch may end within a snapshot; rows that come again after it are passed over.
    parts = [*cuts(made, pieces), [(2, False, "z", "9", 9), (4, False, "a", "1", 1)]]
    got, folder = worked(spark, parts, carried.registry_changes(frames[1].schema), f"snapshot bigint, ends boolean, {shape}")
    assert rows(got, "snapshot", "machine_id", "event") == sorted(expected, key=repr)
    assert rows(carried.kept(spark, folder, "waiting"), "snapshot", "machine_id") == [(4, "a")]
    assert {r.machine_id for r in carried.kept(spark, folder, "last").collect()} == {"a", "c", "d"}
