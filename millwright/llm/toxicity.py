"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted lists, weighted votes, evidence.

Terms are words and, so that unseen forms of a word count, the first bytes of longer words; both are lower-cased and hashed. The
vector space holds the terms that go with the label in the examples (a test of the two shares, ``least_z`` deviations or
more); document frequencies come from all documents. Examples without any such term have the zero vector and are no
one's neighbour. Votes become probabilities by a logistic fit on leave-one-out votes of the examples.

Bounds: at most ``examples`` examples of each class, chosen by a hash of the id, and ``terms`` terms; nothing else is cut.
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
from millwright.session import cut

#: Lengths in bytes of the word beginnings that are terms.
STEMS = (4, 5, 6, 7, 8)
LABELS = "score double, predicted int, neighbours array<struct<doc_id:bigint,similarity:double,label:int>>"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms and the text of each."""
    data = W.lower(data)
    starts, ends, first = W.spans(data, offsets, W.ALNUM)
    doc = W.owners(first)
    terms, docs = [W.hashes(data, starts, ends)], [doc]
    for size in STEMS:
        long = ends - starts > size
        terms.append(W.mix(W.hashes(data, starts[long], starts[long] + size) + np.uint64(1)))
        docs.append(doc[long])
    return np.concatenate(terms), np.concatenate(docs)


class Index:
    """Unit vectors of the examples as inverted lists, cut into blocks of neighbouring examples, with each term's largest weight in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = 64) -> None:
        self.size, self.block, self.blocks = len(vectors), block, max(1, -(-len(vectors) // block))
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        owner = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        order = np.lexsort((owner, term))
        self.owner, self.weight = owner[order], weight[order]
        cell = term[order] * self.blocks + self.owner // block
        self.begin = np.searchsorted(cell, np.arange(terms * self.blocks + 1))
        self.most = np.zeros((terms, self.blocks))
        np.maximum.at(self.most, (term[order], self.owner // block), self.weight)

    def _scores(self, term: np.ndarray, weight: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines with the examples of some blocks, 0 for all others; only the terms' own postings there are read."""
        cells = (term[:, None] * self.blocks + blocks).ravel()
        low, count = self.begin[cells], self.begin[cells + 1] - self.begin[cells]
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.bincount(self.owner[at], weights=np.repeat(np.repeat(weight, len(blocks)), count) * self.weight[at], minlength=self.size)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of largest cosine above 0, of equals those with the smaller number. Blocks are read by their bound, more each time, until it falls below the last of the best."""
        bound = weight @ self.most[term] if len(term) else np.zeros(self.blocks)
        order = np.argsort(-bound, kind="stable")
        order, best, at, step = order[bound[order] > 0], [], 0, 4
        while at < len(order):
            floor = best[-1][0] - 1e-9 if len(best) == k else 0.0
            blocks = order[at : at + step]
            blocks = blocks[bound[blocks] >= floor]
            if not len(blocks):
                break
            scores = self._scores(term, weight, blocks)
            near = np.flatnonzero((scores > 0) & (scores >= floor))
            if len(near) > k + 1:
                near = near[scores[near] >= np.partition(scores[near], -k - 1)[-k - 1] - 1e-9]
            best += [(float(scores[i]), i) for i in near.tolist() if i != without]
            best = sorted(best, key=lambda x: (-round(x[0], 12), x[1]))[:k]
            at, step = at + step, 4 * step
        return best


@dataclass
class Model:
    hashes: np.ndarray
    idf: np.ndarray
    index: Index
    ids: list[int]
    labels: np.ndarray
    fit: tuple[float, float, float]
    k: int

    def vector(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of a text, given the numbers of its terms, repeated ones included."""
        term, count = np.unique(at, return_counts=True)
        weight = (1 + np.log(count)) * self.idf[term]
        return term, weight / max(1e-12, float(np.sqrt(weight @ weight)))

    def vote(self, term: np.ndarray, weight: np.ndarray, without: int = -1) -> tuple[float, float, list[tuple[float, int]]]:
        """The share of the label among the neighbours by weight, and the closeness of the nearest."""
        near = self.index.nearest(term, weight, self.k, without)
        votes = [1 / (1.05 - min(s, 1.0)) for s, _ in near]
        share = sum(v * self.labels[i] for v, (_, i) in zip(votes, near, strict=True)) / sum(votes) if near else 0.0
        return float(share), near[0][0] if near else 0.0, near

    def probability(self, share: float, close: float) -> float:
        a, b, c = self.fit
        return float(1 / (1 + np.exp(-np.clip(a + b * share + c * share * close, -30, 30))))


def _numbers(model_hashes: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(model_hashes):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(model_hashes, h), len(model_hashes) - 1)
    return np.where(model_hashes[at] == h, at, -1)


def _known(hashes: np.ndarray, column: pa.Array):
    """For each text with known terms: its row and their numbers."""
    for low, high, data, offsets in W.texts(column):
        h, doc = _terms(data, offsets)
        number = _numbers(hashes, h)
        known = number >= 0
        number, doc = number[known], doc[known]
        order = np.argsort(doc, kind="stable")
        number, doc = number[order], doc[order]
        cuts = np.searchsorted(doc, np.arange(high - low + 1))
        for d in np.flatnonzero(np.diff(cuts)).tolist():
            yield low + d, number[cuts[d] : cuts[d + 1]]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """A slightly damped logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, damp = np.zeros(x.shape[1]), np.array([1e-3, *[0.02] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(damp), x.T @ (weight * (y - p)) - damp * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", examples: int = 3000, terms: int = 4096, least_z: float = 4.5, k: int = 15) -> Model:
    """Learn from ``labels`` (doc_id and ``label``, null ones left out, of repeated ids the larger) and ``documents`` (doc_id, text)."""
    tune(documents.sparkSession)
    labelled = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("_y"))
    sizes = {r["_y"]: r["n"] for r in labelled.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    # The two samples are of fixed size, so they may be broadcast. Copies would count chance terms as if they were many texts.
    sample = [labelled.where(F.col("_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for y in (1, 0)]
    # One row of each id, the text of the least hash, and then one id of each text: rows are bounded as ids are.
    drawn = documents.select("doc_id", text).join(F.broadcast(sample[0].unionAll(sample[1])), "doc_id")
    one = drawn.groupBy("doc_id", "_y").agg(F.min(F.struct(F.xxhash64(text).alias("_k"), F.col(text).alias("_t"))).alias("r")).select("doc_id", "_y", "r.*")
    distinct = one.groupBy("_k").agg(F.max(F.struct("_y", "doc_id", "_t")).alias("r"))
    chosen = cut(distinct.select(F.col("r.doc_id").cast("bigint").alias("doc_id"), F.col("r._t").alias(text), "r._y"))

    def presence(batches):
        """Terms with the numbers of texts, and of labelled texts, that hold them."""
        held, size = [], 0

        def out():
            term, label_ = (np.concatenate(x) for x in zip(*held, strict=True))
            values, back = np.unique(term, return_inverse=True)
            n, p = np.bincount(back), np.bincount(back, weights=label_).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64()), pa.array(p)], ["term", "n", "p"])

        for batch in batches:
            y = batch.column(2).to_numpy()
            for low, _, data, offsets in W.texts(batch.column(1)):
                h, doc = _terms(data, offsets)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                held.append((h[new], y[low + doc[new]]))
                size += int(new.sum())
            if size > 2_000_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    n, positive = chosen.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0))).first()
    share = positive / max(1, n)
    spread = F.sqrt(F.col("n") * F.lit(max(share * (1 - share), 1e-9)) * F.greatest(1 - F.col("n") / F.lit(n + 1), F.lit(1e-9)))
    off = F.col("p") - F.col("n") * F.lit(share)
    ranked = (
        chosen.mapInArrow(presence, "term bigint, n bigint, p bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
        .withColumn("z", F.signum(off) * F.greatest(F.abs(off) - 0.5, F.lit(0.0)) / spread).where(F.abs("z") >= least_z)
    )
    hashes = np.sort(np.array([r[0] for r in ranked.orderBy(F.abs("z").desc(), "term").limit(terms).select("term").collect()], np.int64).view(np.uint64))

    def count(batches):
        total = np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for _, numbers in _known(hashes, batch.column(0)):
                total[np.unique(numbers)] += 1
        yield from sliced(total)

    df = summed(documents.select(text), count, (len(hashes) + 1,), np.int64)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def restrict(batches):
        for batch in batches:
            held = [np.zeros(0, np.int64)] * batch.num_rows
            for row, numbers in _known(hashes, batch.column(1)):
                held[row] = numbers
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(held, pa.list_(pa.int64()))], ["doc_id", "_y", "terms"])

    rows = sorted((r["doc_id"], r["_y"], r["terms"]) for r in chosen.mapInArrow(restrict, "doc_id bigint, _y int, terms array<bigint>").collect())
    model = Model(hashes, idf, Index([], 1), [r[0] for r in rows], np.array([r[1] for r in rows], np.int64), (0.0, 0.0, 0.0), k)
    vectors = [model.vector(np.array(r[2], np.int64)) for r in rows]
    model.index = Index(vectors, max(1, len(hashes)))
    votes = np.array([model.vote(*v, without=i)[:2] for i, v in enumerate(vectors)]).reshape(-1, 2)
    weight = np.array([sizes.get(y, 1) for y in (0, 1)], float)[model.labels] / np.maximum(1, np.bincount(model.labels, minlength=2))[model.labels]
    prior = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
    if len(rows) and len(set(model.labels.tolist())) == 2:
        x = np.column_stack([votes[:, 0], votes[:, 0] * votes[:, 1]])
        model.fit = _logistic(x, model.labels.astype(float), weight)
    else:
        model.fit = (float(np.log(prior / (1 - prior))), 0.0, 0.0)
    return model


def score(documents: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``documents`` with ``score``, ``predicted`` and ``neighbours`` (the examples that voted, nearest first).

    Texts without known terms, empty and null ones included, get the score of no evidence and no neighbours. Columns of the new names are replaced.
    """
    tune(documents.sparkSession)
    new = ("score", "predicted", "neighbours")
    kept = [c for c in documents.columns if c not in new]
    schema = documents.select(kept).schema
    for field in T.StructType.fromDDL(LABELS):
        schema = schema.add(field)
    near_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))

    def task(batches):
        none = model.probability(0.0, 0.0)
        for batch in batches:
            scores, near = [none] * batch.num_rows, [[] for _ in range(batch.num_rows)]
            for row, numbers in _known(model.hashes, batch.column(kept.index(text))):
                share, close, found = model.vote(*model.vector(numbers))
                scores[row] = model.probability(share, close)
                near[row] = [{"doc_id": model.ids[i], "similarity": s, "label": int(model.labels[i])} for s, i in found]
            values = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(near, near_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], [*kept, *new])

    return documents.select(kept).mapInArrow(task, schema)
