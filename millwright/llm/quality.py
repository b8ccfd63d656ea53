"""Quality of texts: random-indexing word vectors, pooled per text, and a two-layer network with calibrated probabilities.

A unit is a word or the look of a word (case, digits, signs, repetition); both are hashed into ``CELLS`` rows of a
matrix. Every unit has a fixed sparse random vector. A row of the matrix sums, over all texts of the corpus, the random vectors of the
units around its own, so units used alike have like rows. The matrix has a fixed size whatever the corpus holds.

The network is fitted on at most ``examples`` labelled texts, chosen by a hash of the id; a fifth of them sets the temperature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm import words as W
from millwright.llm.sums import sliced, summed, tune

CELLS, WIDTH, SIGNS = 1 << 14, 40, 2
HIDDEN = 24

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@^~=_{}[]\\/")] = True


def _looks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """What each word looks like, as bits."""

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int32)
        np.cumsum(mask, out=total[1:])
        return total[ends] - total[starts]

    upper, lower_, digit = count((data >= 65) & (data <= 90)), count((data >= 97) & (data <= 122)), count((data >= 48) & (data <= 57))
    symbol, bang, length = count(_SYMBOL[data]), count(data == 0x21), ends - starts
    look = (np.minimum(upper, 2) + 3 * (lower_ > 0) + 6 * (digit > 0) + 12 * np.minimum(symbol, 2) + 36 * np.minimum(bang, 2) + 108 * (length > 14) + 216 * (length > 24)).astype(np.uint64)
    nearest = np.zeros(len(h), np.uint64)
    for back in (4, 3, 2, 1):  # how far back the same word stands, if near
        same = np.zeros(len(h), bool)
        same[back:] = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back]) if len(h) > back else False
        nearest[same] = back
    return look + np.uint64(1000) * nearest


def _units(data: np.ndarray, offsets: np.ndarray):
    """First word of each text, and the cells of each word and of its look."""
    starts, ends, first = W.spans(data, offsets, W.SPACED)
    h = W.hashes(W.lower(data), starts, ends)
    doc = W.owners(first)
    look = W.mix(_looks(data, starts, ends, h, doc) + np.uint64(0x5851F42D4C957F2D))
    cell = lambda x: (x & np.uint64(CELLS - 1)).astype(np.int64)
    return first, doc, (h, cell(h)), (look, cell(look))


def _noise(h: np.ndarray):
    """The places and signs of a unit's random vector."""
    for k in range(SIGNS):
        x = W.mix(h + np.uint64(k + 1) * np.uint64(0xD1342543DE82EF95))
        yield (x % np.uint64(WIDTH)).astype(np.int64), np.where(x >> np.uint64(63) == 1, 1.0, -1.0)


def unit_vectors(documents: DataFrame, text: str = "text") -> np.ndarray:
    """The matrix of unit vectors, summed over all ``documents`` and scaled to unit length."""

    def task(batches):
        total = np.zeros(CELLS * WIDTH)
        for batch in batches:
            for _, _, data, offsets in W.texts(batch.column(0)):
                _, doc, word, look = _units(data, offsets)
                for h, _ in (word, look):
                    for place, sign in _noise(h):
                        for step in (-1, 1) if h is word[0] else (-1, 0, 1):  # the neighbour that gives its random vector
                            low, high = max(0, -step), len(h) - max(0, step)
                            if high <= low:
                                continue
                            own = doc[low:high] == doc[low + step : high + step]
                            p, s = place[low + step : high + step][own], sign[low + step : high + step][own]
                            for _, cells in (word, look):
                                total += np.bincount(cells[low:high][own] * WIDTH + p, weights=s, minlength=CELLS * WIDTH)
        yield from sliced(total)

    tune(documents.sparkSession)
    total = summed(documents.select(text), task, (CELLS, WIDTH), np.float64)
    return (total / np.maximum(1e-9, np.sqrt((total**2).sum(axis=1, keepdims=True)))).astype(np.float32)


def _pooled(vectors: np.ndarray, column: pa.Array) -> np.ndarray:
    """For each text the mean vectors of its words and of their looks, and its length."""
    out = []
    for _, _, data, offsets in W.texts(column):
        first, doc, word, look = _units(data, offsets)
        n = np.diff(first)
        parts = [np.log1p(n)[:, None] / 5]
        for _, cells in (word, look):
            total = np.zeros((len(n), WIDTH))
            full = np.flatnonzero(n)
            for at in range(0, len(full), 256):  # a few texts at a time, so that memory stays small
                some = full[at : at + 256]
                low, high = first[some[0]], first[some[-1] + 1]
                total[some] = np.add.reduceat(vectors[cells[low:high]], first[some] - low, axis=0)
            parts.append(total / np.maximum(1, n)[:, None])
        out.append(np.concatenate(parts, axis=1))
    return np.concatenate(out)


@dataclass
class Network:
    """Scaling of the features, two layers, and the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ w1 + b1) @ w2 + b2)[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on batches of 64, then the temperature of least log loss on the fifth part that was kept back."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(x))
    kept, used = order[: len(x) // 5], order[len(x) // 5 :]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    layers = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second, t = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    scaled = np.clip((x - mean) / scale, -8, 8)
    for _ in range(epochs):
        random.shuffle(used)
        for at in range(0, len(used), 64):
            some = used[at : at + 64]
            a = scaled[some]
            hidden = np.tanh(a @ layers[0] + layers[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -30, 30)))
            d = (p - y[some][:, None]) / len(some)
            back = (d @ layers[2].T) * (1 - hidden**2)
            t += 1
            for k, g in enumerate((a.T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0))):
                g = g + 1e-3 * layers[k] / max(1, len(used) // 64)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.01 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    net = Network(mean, scale, tuple(layers))
    if len(kept):
        z, target = net.logits(x[kept]), y[kept]
        loss = lambda s: np.mean(np.logaddexp(0, z / s) - target * z / s)
        net.temperature = float(min(np.geomspace(0.5, 8, 60), key=loss))
    return net


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", examples: int = 8000) -> tuple[np.ndarray, Network]:
    """Unit vectors from all ``documents``; the network from ``labels`` (doc_id and ``label``; null ones are left out, of repeated ids the smaller counts)."""
    vectors = unit_vectors(documents, text)
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.min(label) > 0).cast("double").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    )

    def pool(batches):
        for batch in batches:
            if batch.num_rows:
                x = _pooled(vectors, batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    # One row of each id, the text of the least hash, before any is pooled: rows are bounded as ids are.
    drawn = documents.select("doc_id", text).join(F.broadcast(chosen), "doc_id")
    one = drawn.groupBy("doc_id", "_y").agg(F.min(F.struct(F.xxhash64(text).alias("_k"), F.col(text).alias("_t"))).alias("r"))
    rows = one.select(F.col("doc_id").cast("bigint"), F.col("r._t").alias(text), "_y")
    rows = sorted((r["doc_id"], r["y"], r["x"]) for r in rows.mapInArrow(pool, "doc_id bigint, y double, x array<double>").collect())
    y = np.array([r[1] for r in rows])
    if not len(rows):
        return vectors, fit(np.zeros((10, 1 + 2 * WIDTH)), np.array([0.0, 1.0] * 5), epochs=0)
    return vectors, fit(np.array([r[2] for r in rows]), y)


def score(documents: DataFrame, model: tuple[np.ndarray, Network], text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``documents`` with ``score`` (of label 1) and ``predicted``; columns of these names are replaced. Null and empty texts have zero vectors and get the network's score for these."""
    tune(documents.sparkSession)
    kept = [c for c in documents.columns if c not in ("score", "predicted")]
    schema = documents.select(kept).schema
    for field in T.StructType.fromDDL("score double, predicted int"):
        schema = schema.add(field)
    vectors, net = model

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                p = net.probability(_pooled(vectors, batch.column(kept.index(text))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    return documents.select(kept).mapInArrow(task, schema)
