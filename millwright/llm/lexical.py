"""Ranked lexical search over hashed max-sketches.

The index holds a row for each document: the hashes of its terms with their counts, for exact scores, and a sketch, for
bounds. A sketch has ``WIDTH`` coordinates, of which those above 0 are stored; every term falls on one by its hash, and
the coordinate keeps the largest count of the terms that share it. A term's impact grows with its count, so the largest
count of a coordinate gives the largest impact. A query looks up the coordinates of its terms; the sum of the impacts found
there, each by the term's weight, is no less than the document's score.

Queries are looked up in batches, a block of them at a time: a task takes the documents of a batch for each query by
descending bound and scores them exactly until the bound falls below the query's threshold, the score of its last kept
document. The best of all tasks are merged. Counts of the corpus enter only when queries run, so the index can grow.

Terms are compared by 64-bit hashes of their bytes (``words``). A null text has no terms and is never found. Rows that
repeat an id are documents of their own; of equal scores the smaller id is first, a null id before all others. Rows of one
item id are one query, whose terms are those of all its rows; a null item id is a query too. A query without a term that
any document has finds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm import sums, words
from millwright.session import cut

#: Coordinates of a sketch, a power of two up to 2**16.
WIDTH = 1 << 14
#: Counts from here on are one value, whose impact is the limit of all impacts.
FULL = 255
LIMIT = 1_000_000
#: Terms of queries that are looked up in one pass, and lookups made at once.
BLOCK_TERMS, LOOKUPS = 200_000, 1 << 21
INDEX = "doc_id bigint, n bigint, coords binary, peaks binary, terms binary, counts binary"
FOUND = "query int, doc_id bigint, score bigint"
ROWS = 512


def counted(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: terms of each text; of every text and term, in this order, the text's number, the term's hash and its count."""
    for at, to, data, offsets in words.texts(texts):
        data = words.lower(data)
        starts, ends, first = words.spans(data, offsets, words.ALNUM)
        h, owner = words.hashes(data, starts, ends), words.owners(first)
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        where = np.flatnonzero(new)
        yield np.diff(first), owner[where], h[where], np.diff(np.append(where, len(h)))


def folded(owner: np.ndarray, h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sketches of texts: owner, coordinate and largest count. A coordinate is the hash's first bits, so equal ones are neighbours."""
    coordinate = (h >> np.uint64(64 - (width.bit_length() - 1))).astype(np.uint16)
    new = np.ones(len(h), bool)
    new[1:] = (coordinate[1:] != coordinate[:-1]) | (owner[1:] != owner[:-1])
    where = np.flatnonzero(new)
    peaks = np.maximum.reduceat(counts, where) if len(where) else counts
    return owner[where], coordinate[where], np.minimum(peaks, FULL).astype(np.uint8)


def _packed(values: np.ndarray, owner: np.ndarray, rows: int) -> list[bytes]:
    edges = np.searchsorted(owner, np.arange(rows + 1))
    return [values[edges[k] : edges[k + 1]].tobytes() for k in range(rows)]


def index(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The written index of ``documents`` (doc_id, text); texts without terms are left out."""

    def task(batches):
        for batch in batches:
            at = 0
            for n, owner, h, counts in counted(batch.column(1)):
                rows = len(n)
                place, coords, peaks = folded(owner, h, counts, width)
                out = {
                    "doc_id": batch.column(0).slice(at, rows), "n": pa.array(n, pa.int64()),
                    "coords": pa.array(_packed(coords, place, rows), pa.binary()), "peaks": pa.array(_packed(peaks, place, rows), pa.binary()),
                    "terms": pa.array(_packed(h, owner, rows), pa.binary()), "counts": pa.array(_packed(counts.astype(np.uint32), owner, rows), pa.binary()),
                }
                at += rows
                yield pa.RecordBatch.from_pydict(out).filter(pa.array(n > 0))

    sums.tune(documents.sparkSession, ROWS)
    return cut(documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(task, INDEX))


def query_terms(items: DataFrame) -> DataFrame:
    """The distinct ``item_id, term`` of ``items`` (item_id, text), terms as hashes."""

    def task(batches):
        for batch in batches:
            at = 0
            for n, owner, h, _ in counted(batch.column(1)):
                yield pa.RecordBatch.from_pydict({"item_id": batch.column(0).take(pa.array(at + owner)), "term": pa.array(h.view(np.int64), pa.int64())})
                at += len(n)

    kind = items.schema["item_id"].dataType.simpleString()
    return cut(items.select("item_id", "text").mapInArrow(task, f"item_id {kind}, term bigint").distinct())


def _joined(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of a binary column end to end, and where each starts."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(dtype).itemsize
    values = np.frombuffer(data[int(ends[0]) : int(ends[-1])] if data is not None else b"", np.uint8).copy().view(dtype)
    return values, (ends - ends[0]) // size


def impact(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What ``counts`` occurrences add for each unit of weight, in a document of length factor ``m``."""
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


class Queries:
    """A block of queries: each one's terms with weights, and for each coordinate the queries that look it up."""

    def __init__(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, width: int) -> None:
        order = np.lexsort((term, query))
        query, self.terms, self.weights = query[order], term[order], weight[order]
        self.count = int(query[-1]) + 1 if len(query) else 0
        self.first = np.searchsorted(query, np.arange(self.count + 1))
        coordinate = (self.terms >> np.uint64(64 - (width.bit_length() - 1))).astype(np.int64)
        order = np.argsort(coordinate, kind="stable")
        self.by_coord = np.searchsorted(coordinate[order], np.arange(width + 1))
        self.who, self.worth = query[order], self.weights[order].astype(np.float64)

    def bounds(self, rows: int, owner: np.ndarray, coords: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """The bound of each document and query. Sums stay below 2**53, where doubles are exact."""
        start, many = self.by_coord[coords], np.diff(self.by_coord)[coords]
        total = np.zeros(rows * self.count)
        upto = np.cumsum(many)
        at = 0
        while at < len(coords):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LOOKUPS, "right")))
            lens = many[at:to]
            step = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            one = np.repeat(start[at:to], lens) + step
            low, high = int(owner[at]) * self.count, (int(owner[to - 1]) + 1) * self.count
            cell = np.repeat(owner[at:to] * self.count - low, lens) + self.who[one]
            total[low:high] += np.bincount(cell, self.worth[one] * np.repeat(impacts[at:to], lens), high - low)
            at = to
        return total.reshape(rows, self.count)

    def score(self, query: int, terms: np.ndarray, counts: np.ndarray, m: int) -> int:
        """The exact score of a document, whose terms ascend."""
        own = slice(self.first[query], self.first[query + 1])
        at = np.minimum(np.searchsorted(terms, self.terms[own]), len(terms) - 1)
        same = terms[at] == self.terms[own]
        return int((self.weights[own][same] * impact(counts[at[same]].astype(np.int64), m)).sum())


def best(batches: Iterator[pa.RecordBatch], queries: Queries, documents: int, length: int, k: int) -> Iterator[tuple[int, int | None, int]]:
    """The ``k`` best documents of each query among the index rows of ``batches``, as (query, doc_id, score)."""
    kept: list[list] = [[] for _ in range(queries.count)]
    threshold = np.ones(queries.count)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, n = batch.column(0), batch.column(1).to_numpy()
        m = 10 + 90 * n * documents // length
        coords, edges = _joined(batch.column(2), np.uint16)
        peaks = _joined(batch.column(3), np.uint8)[0].astype(np.int64)
        owner = np.repeat(np.arange(len(n)), np.diff(edges))
        asked = np.diff(queries.by_coord)[coords] > 0
        coords, peaks, owner = coords[asked], peaks[asked], owner[asked]
        bounds = queries.bounds(len(n), owner, coords, np.where(peaks == FULL, LIMIT, impact(peaks, m[owner])))
        terms, first = _joined(batch.column(4), np.uint64)
        counts, _ = _joined(batch.column(5), np.uint32)
        for q in np.flatnonzero(bounds.max(0) >= threshold):
            column = bounds[:, q]
            hopeful = np.flatnonzero(column >= threshold[q])
            for d in hopeful[np.argsort(-column[hopeful], kind="stable")]:
                if column[d] < threshold[q]:
                    break
                own = slice(first[d], first[d + 1])
                if score := queries.score(q, terms[own], counts[own], int(m[d])):
                    doc_id = ids[int(d)].as_py()
                    kept[q].append((-score, doc_id is not None, doc_id or 0))
                    if len(kept[q]) >= 2 * k or len(kept[q]) == k:
                        kept[q] = sorted(kept[q])[:k]
                        threshold[q] = -kept[q][-1][0]
    for q, rows in enumerate(kept):
        for score, known, doc_id in sorted(rows)[:k]:
            yield q, doc_id if known else None, -score


def search(indexed: DataFrame, asked: DataFrame, k: int = 10, width: int = WIDTH, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each query, from an ``index`` and ``query_terms``.

    Blocks of queries come to the driver one at a time; a block has about ``block_terms`` terms, or one query. Building the
    result runs a pass over the index for each block's document counts and one for its search.
    """
    spark = sums.tune(indexed.sparkSession, ROWS)
    documents, length = indexed.agg(F.count("*"), F.sum("n")).first()
    kind = asked.schema["item_id"].dataType.simpleString()
    blocks = -(-asked.count() // block_terms)
    found = []
    for block in range(blocks if documents else 0):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        names = rows.column(0).unique().to_pylist()
        number = {name: q for q, name in enumerate(names)}
        query = np.array([number[x] for x in rows.column(0).to_pylist()], np.int64)
        term = rows.column(1).to_numpy().view(np.uint64)
        known, which = np.unique(term, return_inverse=True)

        def holding(batches, known=known):
            total = np.zeros(len(known), np.int64)
            for batch in batches:
                held = _joined(batch.column(0), np.uint64)[0]
                at = np.minimum(np.searchsorted(known, held), len(known) - 1)
                total += np.bincount(at[known[at] == held], minlength=len(known))
            yield from sums.sliced(total)

        df = sums.summed(indexed.select("terms"), holding, (len(known),), np.int64)
        weight = np.array([math.floor(1000 * math.log((2.0 * documents + 2) / (2.0 * d + 1))) for d in df.tolist()], np.int64)
        queries = Queries(query, term, weight[which], width)

        def task(batches, queries=queries):
            rows = list(best(batches, queries, documents, length, k))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["query", "doc_id", "score"])

        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = indexed.mapInArrow(task, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        title = spark.createDataFrame(list(enumerate(names)), f"query int, item_id {kind}")
        found.append(cut(ranked.join(title, "query").select("item_id", "rank", "doc_id", "score")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
