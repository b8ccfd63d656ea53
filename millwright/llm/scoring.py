"""Log-likelihood of whole texts under a unigram model and under a gated recurrent model, both learnt on Spark.

Word counts are exact and stay a distributed table. The commonest ``HEAD`` words, a table of fixed size, go to the tasks; the
others of a text are looked up by a join on the word. The recurrent model (``recurrent``) gives an output to the commonest
words and one to all others, whose own share of that output is smoothed by their counts. Each task learns from all training texts of its
partition, starting from the same weights; the results are averaged by the tokens seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm import recurrent as R
from millwright.llm import words as W
from millwright.llm.sums import sliced, summed, tune
from millwright.session import cut

HEAD = 1 << 18
BATCH_TOKENS = 1_000_000
#: Texts scored together, unless one batch of rows has more. With few of them most lanes end long before the longest text does.
BATCH_BYTES = 24_000_000
END_HASH = np.uint64(0x9D39247E33776D41)


def _words(column: pa.Array):
    """For a run of rows: the first row, hashes of all words, and the first word of each text."""
    for low, _, data, offsets in W.texts(column):
        data = W.lower(data)
        starts, ends, first = W.spans(data, offsets, W.SPACED)
        yield low, W.hashes(data, starts, ends), first


def count(documents: DataFrame, text: str = "text") -> DataFrame:
    """``hash, n`` of every word and of the end that each text counts. A null text has only its end."""

    def task(batches):
        held, ends, size = [], 0, 0

        def out():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["hash", "n"])

        for batch in batches:
            ends += batch.num_rows
            for _, h, _ in _words(batch.column(0)):
                held.append(h)
                size += len(h)
            if size > 4 * BATCH_TOKENS:
                yield out()
                held, size = [], 0
        if held:
            yield out()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END_HASH]).cast(pa.uint64()).view(pa.int64()), pa.array([ends], pa.int64())], ["hash", "n"])

    tune(documents.sparkSession)
    return documents.select(text).mapInArrow(task, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, head: list[tuple[int, int]], tokens: int, types: int) -> None:
        """``head``: the commonest words (hash, count), the end among them."""
        self.tokens, self.types = tokens, types
        rank = sorted(((n, h) for h, n in head if h != int(END_HASH.view(np.int64))), key=lambda x: (-x[0], x[1]))
        hashes = np.array([h for _, h in rank], np.int64).view(np.uint64)
        counts = np.array([n for n, _ in rank], np.int64)
        self.ends = sum(n for h, n in head if h == int(END_HASH.view(np.int64)))
        own = min(len(rank), R.OTHER)
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts[order]
        # Where the hashes of the same first bits start: about one for each such bucket.
        self.shift = np.uint64(64 - max(1, len(rank).bit_length()))
        buckets = np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << 64 - int(self.shift))
        self.starts = np.concatenate([[0], np.cumsum(buckets)]).astype(np.int32)
        self.outputs = np.where(order < own, order, R.OTHER).astype(np.int16)
        seen = np.zeros(R.OUTPUTS)
        seen[:own] = counts[:own]
        self.other_tokens, self.other_types = tokens - self.ends - int(counts[:own].sum()), types - own - (self.ends > 0)
        seen[R.OTHER], seen[R.END] = self.other_tokens, self.ends
        self.params = R.start(seen)

    def number(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of the hashed words, and their counts: 0 for words outside the head, whose counts the table has."""
        if not len(self.hashes):
            return np.full(len(h), R.OTHER, np.int16), np.zeros(len(h), np.int64)
        outputs, counts = np.full(len(h), R.OTHER, np.int16), np.zeros(len(h), np.int64)
        bucket = (h >> self.shift).astype(np.int64)
        at, stop, left = self.starts[bucket], self.starts[bucket + 1], None
        while True:  # words still sought, each against the next hash of its bucket
            go = np.flatnonzero(at < stop)
            if not len(go):
                return outputs, counts
            left, at, stop = go if left is None else left[go], at[go], stop[go]
            found = self.hashes[at] == h[left]
            outputs[left[found]], counts[left[found]] = self.outputs[at[found]], self.counts[at[found]]
            at = np.where(found, stop, at + 1)

    def sequences(self, outputs: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        end = np.array([R.END], np.int16)
        return [np.concatenate([outputs[a:b], end]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def learn(documents: DataFrame, model: Model, text: str = "text", warm_texts: int = 400, warm_chars: int = 20_000) -> None:
    """Fit the recurrent weights on all ``documents``. A few texts first move the random weights, so that what tasks learn can be averaged:
    ``warm_texts`` whole, distinct ones of at most ``warm_chars`` characters, the first in an order of hashes; copies of one text count once."""
    whole = documents.select(F.xxhash64(text).alias("h"), F.col(text).alias("t")).where(F.length(text).between(1, warm_chars))
    first = [r.h for r in whole.select("h").distinct().orderBy("h").limit(warm_texts).collect()]
    warm = whole.where(F.col("h").isin(first)).groupBy("h").agg(F.min("t").alias("t")).orderBy("h").select("t") if first else whole.select("t").limit(0)
    column = pa.array([r[0] for r in warm.collect()], pa.string())
    if not len(column):
        return
    trainer = R.Trainer(model.params, width=64)
    texts = [s for _, h, first in _words(column) for s in model.sequences(model.number(h)[0], first)]
    for _ in range(3):
        trainer.learn(texts)
    model.params, squares = trainer.p, trainer.squares

    def task(batches):
        own, texts, size = R.Trainer(model.params, squares), [], 0
        for batch in batches:
            for _, h, first in _words(batch.column(0)):
                texts += model.sequences(model.number(h)[0], first)
                size += len(h) + len(first) - 1
            if size >= BATCH_TOKENS:
                own.learn(texts)
                texts, size = [], 0
        if texts:
            own.learn(texts)
        if own.tokens:
            yield from sliced(np.concatenate([R.pack(own.p) * own.tokens, [own.tokens]]))

    total = summed(documents.select(text), task, (R.SIZE + 1,), np.float64)
    if total[-1]:
        model.params = R.unpack(total[:-1] / total[-1])


def train(documents: DataFrame, text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the table of all word counts, written to the shared folder."""
    counts = cut(count(documents, text))
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The commonest words by steps of a sixteenth of a power of two: as many whole steps as fit into the head.
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["step"], r["words"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    total, least = 0, 1 << 30
    for level, words in sizes:
        total += words
        if total > HEAD:
            break
        least = level
    head = counts.where(step >= least)
    end = counts.where(F.col("hash") == int(END_HASH.view(np.int64)))
    model = Model([(r["hash"], r["n"]) for r in head.unionAll(end).distinct().collect()], tokens, types)
    learn(documents, model, text)
    return model, counts


def score(documents: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without ``text``, with ``n_tokens, n_known, train_tokens, base_score, score``; columns of these names are replaced.

    A null text counts as empty: one end. Rows are kept apart whatever their ids.
    """
    tune(documents.sparkSession)
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in documents.columns if c not in (text, *new)]
    rows = documents.select(F.monotonically_increasing_id().alias("_row"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(kept)), F.col(text).alias("_text"))
    own = "_n bigint, _head_known bigint, _head_log double, _lm double, _other bigint, _other_log double, _tail array<struct<hash:bigint,times:int>>"
    schema = rows.drop("_text").schema
    for field in _fields(own):
        schema = schema.add(field)
    names = [f.name for f in _fields(own)]
    tail_type = pa.list_(pa.struct([("hash", pa.int64()), ("times", pa.int32())]))

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, parts = [], []
        for _, h, first in _words(batch.column(batch.num_columns - 1)):
            outputs, n = model.number(h)
            texts += model.sequences(outputs, first)
            log, other = np.log10(n + 1.0), outputs == R.OTHER
            doc = W.owners(first)
            size = len(first) - 1
            total = lambda w: np.bincount(doc, weights=w, minlength=size).astype(float)  # noqa: B023, E731
            # The words outside the head, once for each text, with how often they occur.
            rare = n == 0
            order = np.lexsort((h[rare], doc[rare]))
            who, what = doc[rare][order], h[rare][order]
            at = np.flatnonzero(np.concatenate([[True], (what[1:] != what[:-1]) | (who[1:] != who[:-1])])) if len(what) else np.zeros(0, np.int64)
            times = np.diff(np.append(at, len(what))).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(what[at].view(np.int64)), pa.array(times)], ["hash", "times"])
            tails = pa.ListArray.from_arrays(pa.array(np.searchsorted(who[at], np.arange(size + 1)), pa.int32()), items)
            parts.append((np.diff(first) + 1, total(n > 0).astype(np.int64) + (model.ends > 0), total(log) + np.log10(model.ends + 1.0), total(other).astype(np.int64), total(log * other), tails))
        lengths, known, log, others, other_log, tails = zip(*parts, strict=True)
        lm = R.score(model.params, texts) / np.log(10)
        values = [pa.array(np.concatenate(lengths)), pa.array(np.concatenate(known)), pa.array(np.concatenate(log)), pa.array(lm), pa.array(np.concatenate(others)), pa.array(np.concatenate(other_log)), pa.chunked_array(tails, tail_type).combine_chunks()]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], [*batch.schema.names[:-1], *names])

    def task(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            more = batch.column(batch.num_columns - 1).nbytes
            if held and size + more > BATCH_BYTES:
                yield finish(_one(held))
                held, size = [], 0
            held.append(batch)
            size += more
        if held:
            yield finish(_one(held))

    tune(documents.sparkSession, 2000)
    scored = cut(rows.mapInArrow(task, schema))
    tail = scored.select("_row", F.explode("_tail").alias("t")).select("_row", "t.hash", "t.times")
    log = F.log10(F.coalesce("n", F.lit(0)) + 1.0) * F.col("times")
    looked_up = tail.join(counts, "hash", "left").groupBy("_row").agg(F.sum(log).alias("_tail_log"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("_tail_known"))
    joined = scored.drop("_tail").join(looked_up, "_row", "left")
    tail_log = F.coalesce("_tail_log", F.lit(0.0))
    base = F.col("_head_log") + tail_log - F.col("_n") * F.lit(float(np.log10(model.tokens + model.types + 1)))
    other = F.col("_other_log") + tail_log - F.col("_other") * F.lit(float(np.log10(model.other_tokens + model.other_types + 1)))
    return joined.select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)), F.col("_n").alias("n_tokens"), (F.col("_head_known") + F.coalesce("_tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), (F.col("_lm") + other).alias("score"))


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def _fields(ddl: str):
    from pyspark.sql import types as T

    return T.StructType.fromDDL(ddl).fields


def per_token(score: str = "score") -> Column:
    return F.col(score) / F.col("n_tokens")
