"""Sessions closed by event-time timers, in Spark's keyed state.

Each task folds its samples to stretches without a gap before the shuffle, so a hot machine sends stretches, not samples; the
processor takes them a frame at a time. A machine's state holds its open sessions and one timer, set for the first of them
that can close. A machine that falls silent is closed by its timer and leaves no state.

Time is the watermark of the whole query here; ``carried.session_counts`` follows each partition's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millwright.operators.periods import GRACE_MS, SESSION_GAP_MS
from millwright.session import ship_by_value

ship_by_value(__name__)

SESSION = "machine_id string, windowStart bigint, windowEnd bigint, count bigint"


def folded(frames: Iterator[pd.DataFrame], gap_ms: int) -> Iterator[pd.DataFrame]:
    """Of every frame the stretches of a machine's samples that lie a gap or less apart."""
    for frame in frames:
        rows = frame.dropna(subset=["timestamp"]).astype({"timestamp": "int64"}).sort_values(["machine_id", "timestamp"], ignore_index=True)
        opens = rows["machine_id"].ne(rows["machine_id"].shift()) | (rows["timestamp"].diff() > gap_ms)
        found = rows.groupby([opens.cumsum().rename("g"), "machine_id"], dropna=False)["timestamp"].agg(["min", "max", "count"]).reset_index()
        yield found[["machine_id", "min", "max", "count"]].set_axis(["machine_id", "windowStart", "windowEnd", "count"], axis=1)


class ClosedSessions(StatefulProcessor):
    """Emits each session once, when the watermark has passed its end by the gap."""

    def __init__(self, gap_ms: int) -> None:
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "starts array<bigint>, ends array<bigint>, counts array<bigint>, timer bigint")

    def _load(self) -> tuple[list[list[int]], int | None]:
        if not self.state.exists():
            return [], None
        starts, ends, counts, timer = self.state.get()
        return [[int(a), int(b), int(n)] for a, b, n in zip(starts, ends, counts, strict=True)], int(timer)

    def _store(self, open_: list[list[int]], timer: int | None) -> None:
        """Keep what is open and wake when the first of it can close; nothing is kept of a machine without open sessions."""
        due = min((b for _, b, _ in open_), default=None)
        due = None if due is None else due + self.gap_ms
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.state.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        self.state.update((*(list(c) for c in zip(*open_, strict=True)), due))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        open_, timer = self._load()
        for frame in rows:
            open_ = self.joined([*open_, *frame[["windowStart", "windowEnd", "count"]].astype("int64").to_numpy().tolist()])
        if open_:
            self._store(open_, timer)
        yield from ()

    def joined(self, stretches: list[list[int]]) -> list[list[int]]:
        out: list[list[int]] = []
        for a, b, n in sorted(stretches):
            if out and a - out[-1][1] <= self.gap_ms:
                out[-1] = [out[-1][0], max(out[-1][1], b), out[-1][2] + n]
            else:
                out.append([a, b, n])
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        open_, _ = self._load()
        now = timerValues.getCurrentWatermarkInMs()
        closed = [[key[0], *s] for s in open_ if s[1] + self.gap_ms <= now]
        # The timer that has expired is gone already.
        self._store([s for s in open_ if s[1] + self.gap_ms > now], None)
        if closed:
            yield pd.DataFrame(closed, columns=["machine_id", "windowStart", "windowEnd", "count"])

    def close(self) -> None:
        pass


def closed_sessions(samples: DataFrame, gap_ms: int = SESSION_GAP_MS, grace_ms: int = GRACE_MS) -> DataFrame:
    """machine_id, windowStart, windowEnd, count of every session, once, when no row in time can extend it."""
    stretches = samples.select("machine_id", "timestamp").mapInPandas(lambda frames: folded(frames, gap_ms), SESSION)
    timed = stretches.withColumn("ts", F.timestamp_millis("windowEnd")).withWatermark("ts", f"{grace_ms} milliseconds")
    return timed.groupBy("machine_id").transformWithStateInPandas(
        statefulProcessor=ClosedSessions(gap_ms), outputStructType=SESSION, outputMode="Append", timeMode="EventTime"
    )
