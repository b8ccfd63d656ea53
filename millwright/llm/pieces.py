"""Encoding with a SentencePiece model and decoding, by a streaming Viterbi search.

The vocabulary's merge order decides which pieces may follow one another: a path is the model's encoding just when the
encoding of each two neighbouring pieces put together is these two pieces. So a path scores 0 or minus infinity, and each position
keeps one backpointer. A piece is at most ``longest`` characters long, hence only that many positions can still
be continued. They are the window; ids before the boundary on which all their paths converge are committed, and memory does not grow
with the text. No piece of the vocabulary runs from a character into a following space, so paths always converge there:
texts are cut at these places first, equal cuts are searched once, and many short cuts are searched in lockstep.

Characters outside the vocabulary become the ids of their UTF-8 bytes; no piece reaches over them, so texts are cut there too.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millwright.llm.sums import tune

SPACE = "▁"  # Fixed value: how the model writes a space.
RESULT = "n_ids bigint, ids array<int>, round_trip boolean"
#: Cuts that a task keeps with their ids, and how long such a cut may be.
CACHED, CACHED_LENGTH = 400_000, 64


@dataclass
class Vocabulary:
    """Pieces by id, what is needed to merge them, and the ids of the 256 bytes."""

    names: list[str] = field(repr=False)
    ids: dict[str, int] = field(repr=False)
    rank: list[float] = field(repr=False)  # by id: when the piece is merged; single characters are there from the start
    halves: dict[int, tuple[int, int]] = field(repr=False)  # the last merge that makes a piece; only pieces that are their own encoding
    bytes_: list[int] = field(repr=False)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model of type BPE with byte fallback from a file on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [i for i in range(len(names)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in byte_ids):
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{SPACE}]{SPACE}", names[i]) for i in plain):
            raise ValueError("a piece of the model reaches over a space")
        ids = {names[i]: i for i in plain}
        rank = [-model.get_score(i) if len(names[i]) > 1 else -1.0 for i in range(len(names))]
        halves = {i: h for i in plain if (h := _last_merge(names[i], ids, rank))}
        return cls(names, ids, rank, halves, byte_ids)


def _last_merge(text: str, ids: dict[str, int], rank: list[float]) -> tuple[int, int] | None:
    """Merge the characters in the order of the model, of equal merges the leftmost first: the last two parts, if the whole is reached."""
    parts, last = list(text), (text, text)
    while len(parts) > 1:
        ranked = [(rank[ids[x]], i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in ids]
        if not ranked:
            return None
        i = min(ranked)[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = ["".join(last)]
    return (ids[last[0]], ids[last[1]]) if last[0] in ids and last[1] in ids else None


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.longest = max(map(len, vocabulary.ids), default=1)
        #: A prefix tree: for each node the next ones by character, and the piece that ends there or -1.
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for piece, i in vocabulary.ids.items():
            if i in vocabulary.halves:
                node = 0
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        self.ends.append(-1)
                    node = self.next[node][c]
                self.ends[node] = i
        alphabet = "".join(re.escape(p) for p in vocabulary.ids if len(p) == 1 and p != SPACE)
        self._cuts = re.compile(f"{SPACE}*[{alphabet}]+|{SPACE}+|[^{SPACE}{alphabet}]+" if alphabet else "(?s).+").findall
        self.cache: dict[str, bytes] = {}
        self.follows: dict[int, bool] = {}
        self._lockstep: _Lockstep | None = None

    def _apart(self, left: int, right: int) -> bool:
        """Whether two pieces side by side stay as they are: undo their merges, the latest first, and see that at no
        time the parts at the border would have been merged before them."""
        v, limit = self.v, float("inf")
        while True:
            joined = v.ids.get(v.names[left] + v.names[right])
            if joined is not None and v.rank[joined] < limit:
                return False
            a, b = v.rank[left], v.rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, v.halves[left][1]
            else:  # the border stands to the left of this merge and would go first
                limit, right = b + 0.5, v.halves[right][0]

    def stream(self, characters: Iterable[str]) -> Iterator[tuple[int, list[int]]]:
        """Ids as they are committed, with the position they reach."""
        nodes, ends, follows, size = self.next, self.ends, self.follows, len(self.v.names)
        root = nodes[0]
        base = at = 0  # the boundary committed so far, and how many characters were read
        back: dict[int, tuple] = {0: (0, -1)}  # position: where its last piece starts, and the piece, or the character itself
        alive: list[tuple[int, int]] = []  # positions from which a piece can still be continued, and its node
        for c in characters:
            found, going = None, []
            alive.append((at, 0))
            for start, node in alive:
                node = nodes[node].get(c) if node else root.get(c)
                if node is None:
                    continue
                going.append((start, node))
                if found is None and (piece := ends[node]) >= 0:
                    before = back[start][1]
                    if before.__class__ is str or before < 0:
                        found = (start, piece)
                        continue
                    key = before * size + piece
                    ok = follows.get(key)
                    if ok is None:
                        if len(follows) > 4 * CACHED:
                            follows.clear()
                        ok = follows[key] = self._apart(before, piece)
                    if ok:
                        found = (start, piece)
            back[at + 1] = found or (at, c)
            at, alive = at + 1, going
            if at - base >= 2 * self.longest:
                paths = {at, *(start for start, _ in alive)}
                while len(paths) > 1:  # follow the surviving paths back until they are one
                    latest = max(paths)
                    paths.discard(latest)
                    paths.add(max(base, back[latest][0]))
                if (meet := paths.pop()) > base:
                    yield meet, self._path(back, base, meet)
                    base = meet
                    back = {p: x for p, x in back.items() if p >= meet}
        if at > base:
            yield at, self._path(back, base, at)

    def _path(self, back: dict, base: int, at: int) -> list[int]:
        out: list[int] = []
        while at > base:
            at, piece = back[at]
            if piece.__class__ is str:
                out += [self.v.bytes_[b] for b in reversed(piece.encode("utf-8", "surrogatepass"))]
            else:
                out.append(piece)
        out.reverse()
        return out

    def cuts(self, text: str) -> list[str]:
        """The parts between places where all paths converge: before spaces, and on both sides of characters outside the vocabulary."""
        return self._cuts(SPACE + text.replace(" ", SPACE)) if text else []

    def _learn(self, parts: set[str]) -> None:
        """Encode short parts that are not yet known, all in lockstep."""
        missing = [p for p in parts if p not in self.cache and len(p) <= CACHED_LENGTH]
        if len(self.cache) + len(missing) > CACHED:
            self.cache.clear()
            missing = [p for p in parts if len(p) <= CACHED_LENGTH]
        if len(missing) >= 64:
            self._lockstep = self._lockstep or _Lockstep(self)
            found = self._lockstep.encode(missing)
        else:
            found = [None] * len(missing)
        for part, packed in zip(missing, found, strict=True):
            self.cache[part] = self._packed(part) if packed is None else packed

    def _packed(self, part: str) -> bytes:
        return b"".join(array("i", ids).tobytes() for _, ids in self.stream(part))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed 32-bit numbers."""
        parts = [self.cuts(t) for t in texts]
        self._learn(set().union(*parts))
        known = self.cache
        return [b"".join([known[p] if p in known else self._packed(p) for p in x]) for x in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        out, raw = [], bytearray()
        value = {i: b for b, i in enumerate(self.v.bytes_)}
        for i in ids:
            if i in value:
                raw.append(value[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(self.v.names[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text.removeprefix(" ")


class _Lockstep:
    """The same search for many short parts at once: step ``j`` reads character ``j`` of every part."""

    CODES = 128  # characters that the table of the prefix tree knows; parts with others are read one by one
    SLOTS = 1 << 20

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        single = [c for c in encoder.next[0] if encoder.ends[encoder.next[0][c]] >= 0 and ord(c) < 65536]
        weight = {c: 0 for c in single}
        for step in encoder.next:
            for c in step:
                if c in weight:
                    weight[c] += 1
        chosen = sorted(single, key=lambda c: (-weight[c], c))[: self.CODES - 1]
        self.code = np.zeros(65536, np.uint8)
        self.code[[ord(c) for c in chosen]] = np.arange(1, len(chosen) + 1)
        code = {c: k for k, c in enumerate(chosen, 1)}
        self.table = np.zeros((len(encoder.next), self.CODES), np.int32)
        for node, step in enumerate(encoder.next):
            for c, to in step.items():
                if c in code:
                    self.table[node, code[c]] = to
        self.ends = np.array(encoder.ends, np.int64)
        self.size = len(encoder.v.names)
        self.keys, self.ok, self.used = np.full(self.SLOTS, -1, np.int64), np.zeros(self.SLOTS, bool), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def _allowed(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair may stand side by side, by a hash table that learns."""
        out = np.zeros(len(keys), bool)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        unknown = []
        while len(todo):
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.ok[slot[hit]]
            unknown.append(todo[held == -1])
            going = ~hit & (held != -1)
            todo, slot = todo[going], (slot[going] + 1) & (self.SLOTS - 1)
        new = np.concatenate([np.zeros(0, np.int64), *unknown])
        if len(new):
            values, back = np.unique(keys[new], return_inverse=True)
            if self.used + len(values) > self.SLOTS // 2:
                self.keys[:], self.used = -1, 0
            verdict = np.array([self.encoder._apart(k // self.size, k % self.size) for k in values.tolist()], bool)
            for k, at, v in zip(values.tolist(), self._slot(values).tolist(), verdict.tolist(), strict=True):
                if self.used < self.SLOTS // 2:
                    while self.keys[at] != -1:
                        at = (at + 1) & (self.SLOTS - 1)
                    self.keys[at], self.ok[at] = k, v
                    self.used += 1
            out[new] = verdict[back]
        return out

    def encode(self, parts: list[str]) -> list[bytes | None]:
        """Packed ids, or None for parts with characters that the table does not know."""
        lengths = np.array([len(p) for p in parts])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(points < 65536, self.code[np.minimum(points, 65535)], 0)
        begin = np.cumsum(lengths) - lengths
        known = np.minimum.reduceat(codes, begin) > 0
        chosen = np.flatnonzero(known)
        chosen = chosen[np.argsort(-lengths[chosen], kind="stable")]
        out: list[bytes | None] = [None] * len(parts)
        if not len(chosen):
            return out
        size, first = lengths[chosen], begin[chosen]
        longest = int(size[0])
        back = np.zeros((len(chosen), longest + 1), np.int8)
        piece = np.full((len(chosen), longest + 1), -1, np.int64)
        seg = start = node = np.zeros(0, np.int64)
        for j in range(longest):
            n = int(np.searchsorted(-size, -j, "left"))  # parts longer than j
            going = seg < n
            seg = np.concatenate([seg[going], np.arange(n)])
            start = np.concatenate([start[going], np.full(n, j)])
            node = self.table[np.concatenate([node[going], np.zeros(n, np.int64)]), codes[first[seg] + j]].astype(np.int64)
            going = node > 0
            seg, start, node = seg[going], start[going], node[going]
            at = np.flatnonzero(self.ends[node] >= 0)
            ended, before = self.ends[node[at]], piece[seg[at], start[at]]
            fits = before < 0
            fits[~fits] = self._allowed(before[~fits] * self.size + ended[~fits])
            at, ended = at[fits][::-1], ended[fits][::-1]
            back[seg[at], j + 1], piece[seg[at], j + 1] = start[at], ended
        place, count = size.copy(), np.zeros(len(chosen), np.int64)
        steps = []
        while (open_ := np.flatnonzero(place > 0)).size:
            steps.append((open_, piece[open_, place[open_]]))
            count[open_] += 1
            place[open_] = back[open_, place[open_]]
        ends = np.cumsum(count)
        flat = np.zeros(int(ends[-1]), np.int32)
        for k, (open_, ids) in enumerate(steps):
            flat[ends[open_] - 1 - k] = ids
        packed = flat.tobytes()
        for part, low, high in zip(chosen.tolist(), (4 * (ends - count)).tolist(), (4 * ends).tolist(), strict=True):
            out[part] = packed[low:high]
        return out


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``documents`` with ``n_ids``, ``ids`` and ``round_trip`` (whether the ids decode to the text); columns of these names are replaced.

    Null and empty texts have no ids. The model cannot tell its own space sign in a text from a space; such texts decode with spaces.
    """
    tune(documents.sparkSession, 500)
    new = ("n_ids", "ids", "round_trip")
    kept = [c for c in documents.columns if c not in new]
    schema = documents.select(kept).schema
    for added in T.StructType.fromDDL(RESULT):
        schema = schema.add(added)

    def task(batches):
        encoder = Encoder(vocabulary)
        value = {i: b for b, i in enumerate(vocabulary.bytes_)}
        table = [bytes([value[i]]) if i in value else n.encode() for i, n in enumerate(vocabulary.names)]
        for batch in batches:
            if not batch.num_rows:
                continue
            same, contents = [], [x or "" for x in batch.column(kept.index(text)).to_pylist()]
            packed = encoder.encode_many(contents)
            for content, ids in zip(contents, packed, strict=True):
                raw = b"".join(map(table.__getitem__, np.frombuffer(ids, np.int32).tolist()))
                same.append(raw.decode("utf-8", "replace").replace(SPACE, " ") == (" " + content.replace(SPACE, " ") if content else ""))
            lengths = np.array([len(x) // 4 for x in packed], np.int64)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths), ids, pa.array(same)], [*kept, *new])

    return documents.select(kept).mapInArrow(task, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "text") -> DataFrame:
    """The texts of ``ids``; null ids give a null text."""
    kept = [c for c in encoded.columns if c != into]
    schema = encoded.select(kept).schema.add(T.StructField(into, T.StringType()))

    def task(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch.column(kept.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, into])

    return encoded.select(kept).mapInArrow(task, schema)
