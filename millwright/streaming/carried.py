"""Streams worked a micro-batch at a time by the sliced batch operators, with what follows from earlier batches in small tables.

``foreachBatch`` hands a batch to a step, which returns rows to append and the state after them. State is one row a machine,
partition or open window. It goes into the ordered pass as the slice before all others, or is looked up by a key that is dealt
over several parts; so a machine that brings a whole batch is cut into slices like any other history, and no task, frame or
join key holds all its rows.

Everything is written under the batch's number, and state is read under the number before. A batch that is repeated after a
failure reads the same state, replaces what it wrote and comes to the same rows. The folder belongs to one checkpoint, inside it.

Rows at or below the last offset seen in their partition go aside (``aside``), as their place has passed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming import StreamingQuery

from millwright.operators import changes, matching, periods, readings
from millwright.operators.keyed import looked_up
from millwright.operators.ordered import STREAM_ORDER, over_slices, slice_by_offset, unsliced
from millwright.operators.periods import GRACE_MS, SESSION_GAP_MS, TUMBLING_MS
from millwright.session import new_path
from millwright.streaming.sinks import TRIGGER

POSITIONS = "partition int, reached bigint"
CLOCK = "partition int, reached bigint, seen bigint"

State = Mapping[str, DataFrame]
Tables = dict[str, DataFrame]


class Step:
    """What a batch does: ``states`` names its tables of state with their schemas; ``work`` returns rows to append and the new state."""

    def __init__(self, states: Mapping[str, str], work: Callable[[DataFrame, State, int], tuple[Tables, Tables]]) -> None:
        self.states, self.work = dict(states), work


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _at(folder: str, name: str, batch: int) -> str:
    return f"{folder}/{name}/batch={batch}"


def run_batch(batch: DataFrame, number: int, folder: str, step: Step) -> None:
    """Work one batch. State of the batch before last is removed, as no repetition can ask for it."""
    spark = batch.sparkSession
    before = {
        name: spark.read.schema(schema).parquet(_at(folder, f"state-{name}", number - 1)) if number else spark.createDataFrame([], schema)
        for name, schema in step.states.items()
    }
    held = batch.persist(StorageLevel.MEMORY_AND_DISK)
    out, after = step.work(held, before, number)
    for name, rows in out.items():
        rows.write.mode("overwrite").parquet(_at(folder, name, number))
    for name, rows in after.items():
        rows.select(*before[name].columns).write.mode("overwrite").parquet(_at(folder, f"state-{name}", number))
    held.unpersist()
    for name in step.states:
        if number > 1:
            _delete(spark, _at(folder, f"state-{name}", number - 2))


def start(stream: DataFrame, folder: str, step: Step, once: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(lambda batch, number: run_batch(batch, number, folder, step)).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()


def written(spark: SparkSession, folder: str, name: str = "data") -> DataFrame:
    """The rows that all batches so far have appended."""
    return spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}").drop("batch")


def run_once(stream: DataFrame, step: Step, label: str) -> DataFrame:
    """Run over everything available now; returns the rows written."""
    folder = new_path(stream.sparkSession, label)
    start(stream, folder, step, once=True).awaitTermination()
    return written(stream.sparkSession, folder)


# ---- state beside a batch


def after_positions(batch: DataFrame, positions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows beyond the offset their partition has reached, the others, and the offsets reached now."""
    placed = looked_up(batch, positions.select("partition", "reached"), "partition")
    passed = F.coalesce(F.col("offset") <= F.col("reached"), F.lit(False))
    now = batch.groupBy("partition").agg(F.max("offset").alias("reached")).unionByName(positions.select("partition", "reached"))
    return placed.filter(~passed).drop("reached"), placed.filter(passed).drop("reached"), now.groupBy("partition").agg(F.max("reached").alias("reached"))


def sliced_after(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """Rows sliced by offset, behind the state's rows, which are marked ``_seed``."""
    first = seeds.withColumn("_slice", F.lit(-(2**62)).cast("bigint")).withColumn("_part", F.lit(0).cast("bigint")).withColumn("_seed", F.lit(True))
    return slice_by_offset(rows).withColumn("_seed", F.lit(False)).unionByName(first, allowMissingColumns=True)


def _order() -> Column:
    """Place of a row behind the state's."""
    return F.struct(~F.col("_seed"), "partition", "offset")


# ---- changes and runs


def dedup_consecutive(columns: Sequence[str], value: str, kind: str) -> Step:
    """Rows whose ``value`` differs from the machine's last; nulls pass. The state is the last value."""

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows, aside, positions = after_positions(batch, state["positions"])
        placed = sliced_after(rows, state["last"])
        kept = unsliced(changes.changes_only(placed, value)).filter(~F.col("_seed")).select(*columns)
        last = placed.filter(F.col(value).isNotNull()).groupBy("machine_id").agg(F.max_by(value, _order()).alias(value))
        return {"data": kept, "aside": aside.select(*columns)}, {"last": last, "positions": positions}

    return Step({"last": f"machine_id string, `{value}` {kind}", "positions": POSITIONS}, work)


def execution_run_duration() -> Step:
    """Runs of one state that a change ends. The state is each machine's open run."""
    fields = ("machine_id", "execution", "timestamp", "offset", "partition")

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows, aside, positions = after_positions(changes.execution_events(batch), state["positions"])
        starts = changes.changes_only(sliced_after(rows, state["open"]), "execution")
        ended = over_slices(starts, STREAM_ORDER, lead={"end": F.col("timestamp")})
        done = ended.filter(F.col("end").isNotNull()).select(
            "machine_id", "execution", F.col("timestamp").alias("start"), "end", "offset", "partition", (F.col("end") - F.col("timestamp")).alias("duration"))
        return {"data": done, "aside": aside.select(*fields)}, {"open": ended.filter(F.col("end").isNull()).select(*fields), "positions": positions}

    return Step({"open": "machine_id string, execution string, timestamp bigint, offset bigint, partition int", "positions": POSITIONS}, work)


def part_completed_events() -> Step:
    """Changes of the part counter with the program loaded at that point. The state is each machine's last count and program."""

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows, aside, positions = after_positions(matching.counts_and_loads(batch), state["positions"])
        known = state["parts"]
        counted = known.filter("part_count IS NOT NULL").select("machine_id", "part_count", F.lit(1).alias("_kind"))
        loaded = known.filter("program IS NOT NULL").select("machine_id", F.col("loaded").alias("timestamp"), "program", F.lit(0).alias("_kind"))
        placed = sliced_after(rows, counted.unionByName(loaded, allowMissingColumns=True))
        done = matching.completed_parts(placed, ~F.col("_seed"))
        load, count = F.col("_kind") == 0, F.col("_kind") == 1
        after = placed.groupBy("machine_id").agg(
            F.max_by("part_count", F.when(count, _order())).alias("part_count"),
            F.max_by(F.struct("timestamp", "program"), F.when(load, _order())).alias("l"))
        now = after.select("machine_id", "part_count", F.col("l.timestamp").alias("loaded"), "l.program")
        return {"data": done, "aside": aside}, {"parts": now, "positions": positions}

    return Step({"parts": "machine_id string, part_count bigint, loaded bigint, program string", "positions": POSITIONS}, work)


# ---- readings


def _types(schema: StructType, fields: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in ("machine_id", *fields))


def _last(placed: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The fields of each machine's last row: one value a machine and field, however long the stream."""
    return placed.groupBy("machine_id").agg(F.max_by(F.struct(*fields), _order()).alias("s")).select("machine_id", "s.*")


def _by_reading(schema: StructType, fields: Sequence[str], apply: Callable[[DataFrame], DataFrame], keeps_output: bool) -> Step:
    """A step whose state is each machine's last row, as it came in or as it goes out."""
    columns = schema.names

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows, aside, positions = after_positions(batch, state["positions"])
        placed = sliced_after(rows, state["last"])
        out = apply(placed)
        last = _last(out if keeps_output else placed, fields)
        return {"data": out.filter(~F.col("_seed")).select(*columns), "aside": aside.select(*columns)}, {"last": last, "positions": positions}

    return Step({"last": _types(schema, fields), "positions": POSITIONS}, work)


def delta_encode(schema: StructType, fields: Sequence[str]) -> Step:
    """Readings without the fields that equal the machine's reading before; the state is that reading."""
    return _by_reading(schema, fields, lambda placed: readings.encoded(placed, fields), keeps_output=False)


def delta_decode(schema: StructType, fields: Sequence[str], cleared: Mapping[str, str] = readings.CLEARED) -> Step:
    """The machine's full state after each sample; the state is the last of these."""
    return _by_reading(schema, fields, lambda placed: readings.decoded(placed, fields, cleared), keeps_output=True)


def triggered_fields(schema: StructType, triggers: Mapping[str, Sequence[str]] = readings.TRIGGERS) -> Step:
    """Readings whose dependent fields are kept where their trigger changed; the state is the last value of each trigger."""
    present = [t for t in triggers if t in schema.names]
    return _by_reading(schema, present, lambda placed: readings.triggered(placed, triggers), keeps_output=False)


# ---- fleet


def current_status(log: StructType) -> Step:
    """Newest log row of each machine, whatever the order of arrival. A batch appends the machines whose row is new, numbered by ``update``.

    The state is the whole table, replaced batch by batch: ``kept`` reads it, and ``fleet.current_status`` names the known machines in it.
    """
    fields = ("status", "id", "ts")

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        known = state["last"]
        newest = batch.groupBy("machine_id").agg(F.max_by(F.struct(*fields), "id").alias("s")).select("machine_id", "s.*").unionByName(known)
        now = newest.groupBy("machine_id").agg(F.max_by(F.struct(*fields), "id").alias("s")).select("machine_id", "s.*")
        changed = now.join(known.select("machine_id", "id"), ["machine_id", "id"], "left_anti").select("machine_id", *fields, F.lit(number).cast("bigint").alias("update"))
        return {"data": changed}, {"last": now}

    return Step({"last": _types(log, fields)}, work)


def kept(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of state as the last finished batch left it."""
    stored = spark.read.option("basePath", f"{folder}/state-{name}").parquet(f"{folder}/state-{name}")
    return stored.filter(F.col("batch") == stored.agg(F.max("batch")).scalar()).drop("batch")


def registry_changes(machines: StructType) -> Step:
    """Change events between snapshots of the registry that arrive as rows: ``snapshot``, ``ends`` and the columns of ``machines``.

    A row with ``ends`` says that its snapshot is whole; rows of others wait. Of each whole snapshot against the one before come
    the events of ``fleet.registry_changes``, with its number; a machine that it lacks is a delete. The state is a digest of each
    machine's row in the last whole snapshot, and the rows that wait. Rows of a snapshot that was already worked are passed over.
    """
    fields = [c for c in machines.names if c != "machine_id"]
    whole = "snapshot bigint, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in machines)
    digest = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        done = state["done"].agg(F.max("snapshot")).scalar()
        fresh = batch.filter(F.col("snapshot") > F.coalesce(done, F.lit(-(2**62)).cast("bigint")))
        ends = fresh.filter("ends").select("snapshot").distinct()
        # Few rows: the snapshots that end in this batch.
        ended = ends.withColumn("_at", F.row_number().over(Window.orderBy("snapshot")))
        rows = state["waiting"].unionByName(fresh.filter(~F.coalesce("ends", F.lit(False))).select("snapshot", *machines.names))
        ready = rows.join(ended, "snapshot").dropDuplicates(["snapshot", "machine_id"])
        count = ended.agg(F.max("_at")).scalar()
        old = state["last"].select("machine_id", "digest", F.lit(0).alias("_at"))
        payload = F.struct(*machines.names).alias("_row")
        line = ready.select("machine_id", digest.alias("digest"), "_at", payload).unionByName(old, allowMissingColumns=True)
        by_machine = Window.partitionBy("machine_id").orderBy("_at")
        walked = line.withColumn("_before", F.lag(F.struct("_at", "digest")).over(by_machine)).withColumn("_next", F.lead("_at").over(by_machine))
        follows = F.coalesce(F.col("_before._at") == F.col("_at") - 1, F.lit(False))
        changed = walked.filter((F.col("_at") > 0) & ~(follows & (F.col("_before.digest") == F.col("digest")))).select("_at", "machine_id", "_row")
        stays = F.coalesce(F.col("_next") == F.col("_at") + 1, F.lit(False))
        gone = walked.filter(~stays & (F.col("_at") < count)).select((F.col("_at") + 1).alias("_at"), "machine_id", F.lit(None).cast(line.schema["_row"].dataType).alias("_row"))
        event = F.to_json(F.struct("machine_id", F.col("_row").alias("payload")), {"ignoreNullFields": "false"}).alias("event")
        events = changed.unionByName(gone).join(ended, "_at").select("snapshot", "machine_id", event)
        # Without a whole snapshot in the batch the last one stays.
        last = line.filter(F.col("_at") == F.coalesce(count, F.lit(0))).select("machine_id", "digest")
        waiting = rows.join(ended, "snapshot", "left_anti")
        now = state["done"].unionByName(ends).agg(F.max("snapshot").alias("snapshot"))
        return {"data": events}, {"last": last, "waiting": waiting, "done": now}

    return Step({"last": "machine_id string, digest string", "waiting": whole, "done": "snapshot bigint"}, work)


# ---- sessions

SESSION = "machine_id string, windowStart bigint, windowEnd bigint, count bigint"


def merged(known: DataFrame, folded: DataFrame, gap_ms: int, keys: Sequence[str] = ("machine_id",)) -> DataFrame:
    """Sessions that share a gap or less as one."""
    by_start = Window.partitionBy(*keys).orderBy("windowStart", "windowEnd")
    both = known.select(*folded.columns).unionByName(folded).withColumn(
        "_reach", F.max("windowEnd").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.col("_reach").isNull() | (F.col("windowStart") - F.col("_reach") > gap_ms)
    numbered = both.withColumn("_g", F.sum(opens.cast("int")).over(by_start))
    return numbered.groupBy(*keys, "_g").agg(
        F.min("windowStart").alias("windowStart"), F.max("windowEnd").alias("windowEnd"), F.sum("count").alias("count")).drop("_g")


def _extended(rows: DataFrame, known: DataFrame, gap_ms: int, grace_ms: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The machines' sessions with the batch's rows, those that a row can still reach, and rows that are late.

    A row is late if it lies before every session that is kept, by more than a gap, and before the machine's newest row by
    more than a gap and the grace.
    """
    newest = rows.groupBy("machine_id").agg(F.max("timestamp").alias("newest"), F.lit(None).cast("bigint").alias("oldest"))
    kept = known.groupBy("machine_id").agg(F.max("windowEnd").alias("newest"), F.min("windowStart").alias("oldest"))
    limits = newest.unionByName(kept).groupBy("machine_id").agg(F.max("newest").alias("_newest"), F.min("oldest").alias("_oldest"))
    bounded = looked_up(rows, limits, "machine_id")
    # Without a kept session nothing is known to be missing, so the first rows of a machine are never late.
    late = F.coalesce(F.col("timestamp") < F.least(F.col("_oldest") - gap_ms, F.col("_newest") - gap_ms - grace_ms), F.lit(False)) & F.col("_oldest").isNotNull()
    fresh = bounded.filter(~late)
    now = merged(known, periods.sessions(fresh, gap_ms), gap_ms)
    by_machine = Window.partitionBy("machine_id")
    reachable = now.withColumn("_newest", F.max("windowEnd").over(by_machine)).filter(F.col("windowEnd") >= F.col("_newest") - gap_ms - grace_ms)
    return now, reachable.drop("_newest"), bounded.filter(late).select(*rows.columns)


def session_counts_live(gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> Step:
    """What became of every session that a batch touched, numbered by ``update``; see ``live_sessions`` for what the updates come to.

    Rows may come late: a session is extended at either end, and a row between two makes them one. A session that another
    has taken in is named once more, without a count. Rows too late for any session come out as ``late``.
    """

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows = batch.select("machine_id", "timestamp", "offset", "partition").filter(F.col("timestamp").isNotNull())
        now, reachable, late = _extended(rows, state["sessions"], gap_ms, grace_ms)
        key = ["machine_id", "windowStart"]
        old = state["sessions"].select(*key, F.col("windowEnd").alias("_end"), F.col("count").alias("_count"))
        touched = now.join(old, key, "left").filter(~(F.col("_end").eqNullSafe(F.col("windowEnd")) & F.col("_count").eqNullSafe(F.col("count")))).select(*now.columns)
        gone = state["sessions"].join(now.select(*key), key, "left_anti").withColumn("count", F.lit(None).cast("bigint"))
        passed = late.select("machine_id", F.col("timestamp").alias("windowStart"), F.col("timestamp").alias("windowEnd"), F.lit(1).cast("bigint").alias("count"))
        updates = touched.unionByName(gone.select(*now.columns)).withColumn("late", F.lit(False)).unionByName(passed.withColumn("late", F.lit(True)))
        out = updates.withColumn("update", F.lit(number).cast("bigint")).select("machine_id", "windowStart", "windowEnd", "count", "update", "late")
        return {"data": out}, {"sessions": reachable}

    return Step({"sessions": SESSION}, work)


def live_sessions(updates: DataFrame) -> DataFrame:
    """The sessions by the newest of their updates; those that others have taken in are gone."""
    newest = F.max_by(F.struct("windowEnd", "count"), "update").alias("u")
    found = updates.filter(~F.col("late")).groupBy("machine_id", "windowStart").agg(newest)
    return found.filter(F.col("u.count").isNotNull()).select("machine_id", "windowStart", "u.windowEnd", "u.count")


def execution_with_session(gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> Step:
    """State changes with the start that their session has when the batch is worked, -1 for those too late for any."""
    fields = ("machine_id", "execution", "timestamp", "offset", "partition")
    changed = dedup_consecutive(fields, "execution", "string")

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        out, after = changed.work(changes.execution_events(batch), state, number)
        rows = batch.select("machine_id", "timestamp", "offset", "partition").filter(F.col("timestamp").isNotNull())
        now, reachable, _ = _extended(rows, state["sessions"], gap_ms, grace_ms)
        return {"data": matching.session_lookup(out["data"], now), "aside": out["aside"]}, {**after, "sessions": reachable}

    return Step({**changed.states, "sessions": SESSION}, work)


# ---- time of a partition's own


def _with_clock(batch: DataFrame, clock: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with ``_seen``, the highest valid time in their partition up to them; rows whose place has passed; and the clock after the batch."""
    rows, aside, reached = after_positions(batch, clock)
    valid = F.when(F.col("timestamp") >= 0, F.col("timestamp"))
    seeds = clock.filter(F.col("seen").isNotNull()).select("partition", F.col("seen").alias("timestamp"))
    seen = over_slices(sliced_after(rows, seeds), ("offset",), ("partition",), peak={"_seen": valid}).filter(~F.col("_seed"))
    highest = rows.groupBy("partition").agg(F.max(valid).alias("seen")).unionByName(clock.select("partition", "seen"))
    after = reached.join(highest.groupBy("partition").agg(F.max("seen").alias("seen")), "partition")
    return unsliced(seen).drop("_seed"), aside, after.select("partition", "reached", "seen")


def repaired_event_time(columns: Sequence[str]) -> Step:
    """Invalid times become the highest time seen earlier in the partition, null if there is none; the state is that time."""

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        rows, aside, clock = _with_clock(batch, state["clock"])
        usable = F.when(F.col("timestamp") >= 0, F.col("timestamp")).otherwise(F.col("_seen"))
        return {"data": rows.withColumn("timestamp", usable).select(*columns), "aside": aside.select(*columns)}, {"clock": clock}

    return Step({"clock": CLOCK}, work)


OPEN = "partition int, machine_id string, windowStart bigint, windowEnd bigint, count bigint"


def _closing(open_: DataFrame, clock: DataFrame, closed: Column) -> tuple[DataFrame, DataFrame]:
    timed = looked_up(open_, clock.select("partition", "seen"), "partition")
    over = F.coalesce(closed, F.lit(False))
    return timed.filter(over).drop("seen", "partition"), timed.filter(~over).drop("seen")


def window_counts(width_ms: int = TUMBLING_MS, slide_ms: int | None = None, grace_ms: int = GRACE_MS) -> Step:
    """Counts per machine and window, each once, when its partition's time has passed the window's end by the grace.

    A row counts in the windows that are still open at its place in the partition, so a partition that lags behind others
    loses nothing, and the counts don't depend on how the stream is cut into batches. Late rows go aside.
    """
    slide = slide_ms or width_ms
    if width_ms % slide:
        raise ValueError("the width must be a multiple of the slide")

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        slim = batch.select("machine_id", "timestamp", "offset", "partition").filter(F.col("timestamp") >= 0)
        rows, aside, clock = _with_clock(slim, state["clock"])
        step = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(slide))
        # How many of the row's windows, from the oldest, are closed where it stands.
        behind = F.col("_seen") - grace_ms - step - slide
        rows = rows.withColumn("_step", step).withColumn("_first", F.greatest(F.lit(0), F.floor(behind / slide) + 1).cast("bigint"))
        late = F.col("_first") >= width_ms // slide
        # Rows alike in step and first open window are one row from here on.
        folded = rows.filter(~late).groupBy("partition", "machine_id", "_step", "_first").agg(F.count("*").alias("n"))
        starts = F.sequence(F.col("_step") - (width_ms - slide) + F.col("_first") * slide, F.col("_step"), F.lit(slide))
        opened = folded.select("partition", "machine_id", F.explode(starts).alias("windowStart"), "n").groupBy("partition", "machine_id", "windowStart").agg(F.sum("n").alias("count"))
        opened = opened.withColumn("windowEnd", F.col("windowStart") + width_ms)
        every = state["open"].unionByName(opened).groupBy("partition", "machine_id", "windowStart", "windowEnd").agg(F.sum("count").alias("count"))
        done, rest = _closing(every, clock, F.col("windowEnd") + grace_ms <= F.col("seen"))
        dropped = rows.filter(late).select(*slim.columns).unionByName(aside.select(*slim.columns))
        return {"data": done.select("machine_id", "windowStart", "windowEnd", "count"), "aside": dropped}, {"clock": clock, "open": rest}

    return Step({"clock": CLOCK, "open": OPEN}, work)


def session_counts(gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> Step:
    """Counts per machine and session, each once, when its partition's time has passed the session's end by gap and grace.

    A row is late if it is more than the grace behind its partition's time; late rows go aside. Rows in time can't reach
    a session that is closed, so the counts don't depend on how the stream is cut into batches.
    """

    def work(batch: DataFrame, state: State, number: int) -> tuple[Tables, Tables]:
        slim = batch.select("machine_id", "timestamp", "offset", "partition").filter(F.col("timestamp") >= 0)
        rows, aside, clock = _with_clock(slim, state["clock"])
        late = F.col("timestamp") < F.col("_seen") - grace_ms
        keys = ("partition", "machine_id")
        folded = periods.sessions(rows.filter(~late), gap_ms, keys)
        every = merged(state["open"], folded, gap_ms, keys)
        done, rest = _closing(every, clock, F.col("windowEnd") + gap_ms + grace_ms < F.col("seen"))
        dropped = rows.filter(late).select(*slim.columns).unionByName(aside.select(*slim.columns))
        return {"data": done.select("machine_id", "windowStart", "windowEnd", "count"), "aside": dropped}, {"clock": clock, "open": rest}

    return Step({"clock": CLOCK, "open": OPEN}, work)
