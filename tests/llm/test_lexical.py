import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millwright.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id bigint, text string, score string, rank string, doc_id string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """Every score by the formula, of every pair."""
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    count, length = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in asked.items():
        scored = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * count // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in query if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -score) for rank, (score, known, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, **how):
    indexed = lexical.index(spark.createDataFrame(docs, "doc_id bigint, text string"), how.get("width", lexical.WIDTH))
    asked = lexical.query_terms(spark.createDataFrame(items, "item_id bigint, text string"))
    return sorted((tuple(r) for r in lexical.search(indexed, asked, **how).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 400}é" for _ in range(4000)]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.choice([1, 5, 40, 300])))) for i in range(300)]
    docs += [(i, docs[i][1]) for i in range(20)] + [(900, None), (901, ""), (902, "..!"), (None, docs[3][1]), (903, "W1É Q " * 400), (904, "É é É")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 8, 30])))) for i in range(25)]
    items += [(3, "w7é extra"), (None, docs[3][1]), (50, None), (51, "nowhere"), (52, "- -"), (53, docs[9][1] * 3), (54, "q é É")]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"width": 16}, {"block_terms": 60}, {"k": 3}])
def test_against_all_scores(spark, corpus, how):
    assert search(spark, *corpus, **how) == plain(*corpus, k=how.get("k", 10))


def test_bounds_are_no_less_than_scores_and_most_documents_are_not_scored(corpus):
    docs, items = corpus
    (n, owner, h, counts), = lexical.counted(pa.array([t for _, t in docs], pa.string()))
    where, coords, peaks = lexical.folded(owner, h, counts, 64)
    m = 10 + 90 * n.astype(np.int64) * len(docs) // n.sum()
    (_, query, term, _), = lexical.counted(pa.array([t for _, t in items], pa.string()))
    queries = lexical.Queries(query, term, np.arange(len(term), dtype=np.int64) % 90, 64)
    impacts = np.where(peaks == lexical.FULL, lexical.LIMIT, lexical.impact(peaks.astype(np.int64), m[where]))
    bounds = queries.bounds(len(n), where, coords, impacts)
    for d in range(len(n)):
        own = owner == d
        for q in range(queries.count):
            if own.any():
                assert queries.score(q, h[own], counts[own], int(m[d])) <= bounds[d, q]


def test_threshold_ends_the_scoring(spark, corpus, monkeypatch):
    docs, items = corpus
    (n, owner, h, counts), = lexical.counted(pa.array([t for _, t in docs], pa.string()))
    calls, score = [], lexical.Queries.score
    monkeypatch.setattr(lexical.Queries, "score", lambda *a: calls.append(1) or score(*a))
    place, coords, peaks = lexical.folded(owner, h, counts, lexical.WIDTH)
    rows = len(n)
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array([i for i, _ in docs], pa.int64()), "n": pa.array(n, pa.int64()),
        **{name: pa.array(lexical._packed(v, o, rows), pa.binary()) for name, v, o in (("coords", coords, place), ("peaks", peaks, place), ("terms", h, owner), ("counts", counts.astype(np.uint32), owner))}})
    (_, query, term, _), = lexical.counted(pa.array([t for _, t in items], pa.string()))
    list(lexical.best(iter([batch]), lexical.Queries(query, term, np.full(len(term), 500, np.int64), lexical.WIDTH), rows, int(n.sum()), 10))
    assert len(calls) < 0.25 * rows * len(items)


def test_a_long_text_and_extra_columns(spark):
    docs = [(1, "alpha " * 400_000 + "omega", "x", 1), (2, "omega beta", "y", 2), (3, "beta", "z", 3)]
    items = [(1, "omega alpha", "", "", ""), (2, "beta", "", "", "")]
    indexed = lexical.index(spark.createDataFrame(docs, "doc_id bigint, text string, term string, n int"))
    got = lexical.search(indexed, lexical.query_terms(spark.createDataFrame(items, ITEM)))
    assert sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr) == plain([d[:2] for d in docs], [i[:2] for i in items])


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a")], []) == []
