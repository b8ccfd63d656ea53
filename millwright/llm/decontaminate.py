"""Benchmark decontamination by a suffix automaton over the words of the test items.

The items' words are numbered and all items go into one generalised suffix automaton. A document is read word by word;
the automaton keeps the longest stretch of words ending here that some item contains. A stretch of ``window`` words, or
one that ends with a whole shorter item, is a hit. Only stretches whose neighbouring word pairs all occur in the items
are read at all; the pairs are looked up for whole blocks of text at once.

The items lie in the shared folder, every text once, in shards of at most about ``shard_words`` words, and tasks read the
shard they need there; none passes through the driver. Each shard is a stage of its own, so a worker holds one automaton
at a time; a further shard costs one more pass and no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm import words as W
from millwright.llm.sums import _store, tune
from millwright.session import cut, new_path

#: Words: letters, digits and all beyond ASCII; everything is lower-cased first.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
FOUND = "hit_runs array<struct<start:int,end:int>>, hit_items array<string>"


class Automaton:
    """Generalised suffix automaton over sequences of numbers."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.whole: list[int] = [0]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.whole.append(0)
        return len(self.step) - 1

    def _split(self, at: int, symbol: int, target: int) -> int:
        """The state of the suffixes of ``target`` that are one longer than those of ``at``."""
        clone = self._state(self.length[at] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = clone
        while at != -1 and self.step[at].get(symbol) == target:
            self.step[at][symbol] = clone
            at = self.link[at]
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            target = self.step[last][symbol]
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target)
        new, at = self._state(self.length[last] + 1, 0, {}), last
        while at != -1 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at != -1:
            target = self.step[at][symbol]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, symbol, target)
        return new

    def add(self, sequence: Iterable[int]) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)

    def read(self, sequence: Iterable[int]):
        """After each symbol: the length of the longest known stretch that ends there."""
        state = length = 0
        for symbol in sequence:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if symbol in self.step[state]:
                state = self.step[state][symbol]
                length += 1
            yield length


class Benchmark:
    """One shard of the items: its automaton, the items of each window, and what finds stretches worth reading."""

    def __init__(self, items: list[tuple[list[str], str]], window: int) -> None:
        self.window, self.automaton = window, Automaton()
        self.numbers: dict[str, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = {}
        known = []
        for own, text in items:
            found = re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
            if not found:
                continue
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in found]
            self.automaton.add(ids)
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1):
                self.items.setdefault(tuple(ids[k : k + size]), set()).update(own)
            known.append(found)
        #: Lengths of the shorter items, each of which is a window of its own.
        self.short = sorted({len(x) for x in self.items if len(x) < window})
        words = sorted(self.numbers)
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        h = W.hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], np.array([self.numbers[w] for w in words], np.int64)[order]
        pairs = {(self.numbers[a], self.numbers[b]) for x in known for a, b in zip(x, x[1:], strict=False)}
        self.pairs = np.array(sorted(a * len(self.numbers) + b for a, b in pairs), np.int64)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the hashed words, -1 for those of no item."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], -1)

    def hits(self, ids: np.ndarray, first: np.ndarray):
        """For a block of documents: (document, start, end, items) of every occurring window, in words of the document."""
        if not len(ids) or not self.items:
            return
        known = ids >= 0
        joined = np.zeros(len(ids), bool)  # whether a word continues a stretch of known pairs
        if len(self.pairs) and len(ids) > 1:
            key = np.where(known[:-1] & known[1:], ids[:-1] * len(self.numbers) + ids[1:], -1)
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[1:] = self.pairs[at] == key
        joined[first[:-1][first[:-1] < len(ids)]] = False
        starts = np.flatnonzero(known & ~joined)
        after = np.flatnonzero(~joined)
        ends = np.append(after, len(ids))[np.searchsorted(after, starts, "right")]
        least = min([*self.short[:1], self.window])
        long = ends - starts >= least
        doc = np.searchsorted(first, starts[long], "right") - 1
        for d, a, b in zip(doc.tolist(), starts[long].tolist(), ends[long].tolist(), strict=True):
            sequence, base = ids[a:b].tolist(), int(first[d])
            for i, length in enumerate(self.automaton.read(sequence)):
                for size in [s for s in self.short if s <= length] + [self.window] * (length >= self.window):
                    if (found := tuple(sequence[i + 1 - size : i + 1])) in self.items:
                        yield d, a - base + i + 1 - size, a - base + i + 1, self.items[found]


def _merge(runs: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


def shards(benchmark: DataFrame, shard_words: int) -> list[str]:
    """Folders of the items, every text once with the names of its items, dealt by a hash of the text.

    A word and what parts it from the next take two bytes at least, so the bytes bound the words. One item is not divided.
    """
    items = cut(benchmark.where("length(text) > 0").groupBy("text").agg(F.collect_set(F.col("item_id").cast("string")).alias("names")))
    counted = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    count = max(1, -(-counted // (2 * shard_words)))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(count)))
    path = new_path(benchmark.sparkSession, "cut")
    dealt.repartition(F.col("shard")).write.partitionBy("shard").parquet(path)
    return [f"{path}/shard={r[0]}" for r in dealt.select("shard").distinct().orderBy("shard").collect()]


def _items(folder: str | None) -> list[tuple[list[str], str]]:
    """The items of a shard, read by a task."""
    if folder is None:
        return []
    store, at = _store(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet"))
    rows = (r for f in files for r in pq.read_table(store.open_input_file(f), columns=["names", "text"]).to_pylist())
    return [(r["names"], r["text"]) for r in rows]


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", shard_words: int = 800_000) -> DataFrame:
    """``documents`` with ``n_words``, ``hit_runs`` (merged word spans that occur in items) and ``hit_items``.

    Null and empty texts have no words. Items without words occur nowhere; items with a null id hit but are not named;
    repeated items count once. A column of ``documents`` that bears one of the new names is replaced.
    """
    return _read_shards(documents, shards(benchmark, shard_words), window, text)


def _read_shards(documents: DataFrame, folders: list[str], window: int, text: str) -> DataFrame:
    tune(documents.sparkSession)
    out = documents.drop("n_words", "hit_runs", "hit_items")
    for k, folder in enumerate(folders or [None]):
        # Written in between: steps of one stage would keep their workers, and automata, alive together.
        out = _read_shard(cut(out) if k else out, folder, window, text, more=k > 0)
    return out


def _read_shard(documents: DataFrame, folder: str | None, window: int, text: str, more: bool) -> DataFrame:
    kept = [c for c in documents.columns if c not in ("n_words", "hit_runs", "hit_items")]
    at = kept.index(text)
    schema = documents.drop("n_words", "hit_runs", "hit_items").schema
    for field in T.StructType.fromDDL("n_words bigint, " + FOUND):
        schema = schema.add(field)
    types = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())]

    def task(batches):
        bench = Benchmark(_items(folder), window)
        for batch in batches:
            counts, runs, names = [], [[] for _ in range(batch.num_rows)], [set() for _ in range(batch.num_rows)]
            if more:
                for i, (r, n) in enumerate(zip(batch.column(len(kept) + 1).to_pylist(), batch.column(len(kept) + 2).to_pylist(), strict=True)):
                    runs[i], names[i] = [(x["start"], x["end"]) for x in r], set(n)
            for low, _, data, offsets in W.texts(batch.column(at)):
                data = W.lower(data)
                starts, ends, first = W.spans(data, offsets, W.ALNUM)
                counts.append(np.diff(first))
                for d, a, b, found in bench.hits(bench.number(W.hashes(data, starts, ends)), first):
                    runs[low + d].append((a, b))
                    names[low + d] |= found
            if not batch.num_rows:
                continue
            values = [np.concatenate(counts), [_merge(r) for r in runs], [sorted(n) for n in names]]
            columns = [*batch.columns[: len(kept)], *(pa.array(v, t) for v, t in zip(values, types, strict=True))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "hit_runs", "hit_items"])

    return documents.select(*kept, *(["n_words", "hit_runs", "hit_items"] if more else [])).mapInArrow(task, schema)


def n_hit() -> Column:
    """Words inside any hit."""
    return F.aggregate("hit_runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])


def contaminated() -> Column:
    """The verdict: at least a twentieth of the words are hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query, one row for each document."""
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def removed(found: DataFrame, text: str = "text") -> DataFrame:
    """What ``contamination`` returned, with the words of ``hit_runs`` and all between them cut out of ``text``."""
    at, runs_at = found.columns.index(text), found.columns.index("hit_runs")

    def task(batches):
        for batch in batches:
            runs = batch.column(runs_at).to_pylist()
            if any(runs):
                column, own = batch.column(at), batch.column(at).to_pylist()
                for low, high, data, offsets in W.texts(column):
                    if not any(runs[low:high]):
                        continue
                    starts, ends, first = W.spans(data, offsets, W.ALNUM)
                    for d in (d for d in range(high - low) if runs[low + d]):
                        base, left, parts = int(first[d]), int(offsets[d]), []
                        for r in runs[low + d]:
                            parts.append(data[left : starts[base + r["start"]]])
                            left = int(ends[base + r["end"] - 1])
                        own[low + d] = np.concatenate([*parts, data[left : offsets[d + 1]]]).tobytes().decode()
                batch = batch.set_column(at, text, pa.array(own, column.type))
            yield batch

    return found.mapInArrow(task, found.schema)


def without_passages(documents: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", shard_words: int = 800_000) -> DataFrame:
    """``documents`` that are not ``contaminated``, every benchmark passage cut out of their texts.

    What stood left and right of a passage may form another one, so texts that were cut are read again until none has a hit;
    each time they lose words, so this ends. Only they are written in between, which also keeps Python workers of several steps from being alive at once.
    """
    folders = shards(benchmark, shard_words)
    found = _read_shards(documents, folders, window, text).where(~contaminated())
    clean = [found.where(n_hit() == 0)]
    hit = cut(found.where(n_hit() > 0))
    while not hit.isEmpty():
        found = cut(_read_shards(cut(removed(hit, text)), folders, window, text))
        clean.append(found.where(n_hit() == 0))
        hit = found.where(n_hit() > 0)
    return reduce(DataFrame.unionByName, clean).drop("n_words", "hit_runs", "hit_items")


def without_hits(text: str, runs: list[tuple[int, int]]) -> str:
    """A text without the hit words, as spans of words from ``contamination``."""
    bounds = [m.span() for m in re.finditer(WORD, text)]
    at, out = 0, []
    for a, b in runs:
        out.append(text[at : bounds[a][0]])
        at = bounds[b - 1][1]
    return "".join([*out, text[at:]])

