import numpy as np
import pytest

from millwright.llm import quality, toxicity
from millwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label):
    rows = QUERIES[name](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    return [(r[label], r.predicted) for r in rows if r[label] is not None]


def test_quality_on_held_out_documents(spark):
    pairs = held_out(spark, "op4_quality_classifier", "quality")
    assert len(pairs) > 40 and sum(a == b for a, b in pairs) >= 0.95 * len(pairs)


def test_toxicity_on_held_out_documents(spark):
    pairs = held_out(spark, "op9_toxicity", "toxic")
    clean = [b for a, b in pairs if a == 0]
    assert sum(clean) <= 0.03 * len(clean) and sum(b for a, b in pairs if a) >= 0.5 * sum(a for a, _ in pairs)


def test_index_equals_all_comparisons():
    r = np.random.default_rng(1)
    vectors = []
    for _ in range(300):
        term = np.sort(r.choice(40, r.integers(0, 6), replace=False))
        w = r.integers(1, 4, len(term)).astype(float)
        vectors.append((term, w / max(1e-12, np.sqrt((w**2).sum()))))
    dense = np.zeros((300, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.Index(vectors, 40, block=16)
    for q in range(60):
        all_ = sorted(((round(float(s), 12), i) for i, s in enumerate(dense @ dense[q]) if s > 1e-12 and i != q), key=lambda x: (-x[0], x[1]))[:7]
        got = [(round(s, 12), i) for s, i in index.nearest(*vectors[q], 7, without=q)]
        assert [i for _, i in got] == [i for _, i in all_] and np.allclose([s for s, _ in got], [s for s, _ in all_])


def labelled(spark, docs):
    texts = [f"calm words number {i} here" for i in range(60)] + [f"you vile{i % 3} creature number {i}" for i in range(40)] + [None, "", "calm words number 1 here"]
    labels = spark.createDataFrame([(i, int(60 <= i < 100), int(i < 60)) for i in range(100)] + [(None, 1, 1), (4, None, None), (4, 0, 1)], "doc_id bigint, toxic int, quality int")
    return docs(texts), labels


def test_evidence_and_odd_rows(spark, docs):
    documents, labels = labelled(spark, docs)
    model = toxicity.train(documents, labels, least_z=3.0)
    rows = {r.doc_id: r for r in toxicity.score(documents, model).collect()}
    assert len(rows) == 103 and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[70].predicted == 1 and rows[70].neighbours[0].label == 1 and rows[100].predicted == rows[101].predicted == rows[5].predicted == 0
    assert rows[100].score == rows[101].score and rows[102].score == rows[1].score


@pytest.mark.parametrize("train, score", [(toxicity.train, toxicity.score), (quality.train, quality.score)])
def test_no_labels_or_no_documents(spark, docs, train, score):
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    model = train(docs(["a b", None]), none)
    assert all(0 <= r.score <= 1 for r in score(docs(["a b", None, ""]), model).collect())
    assert score(docs([]), train(docs([]), none)).collect() == []


def test_quality_of_odd_rows(spark, docs):
    documents, labels = labelled(spark, docs)
    rows = {r.doc_id: r for r in quality.score(documents, quality.train(documents, labels)).collect()}
    assert rows[100].score == rows[101].score and rows[102].score == rows[1].score and rows[1].rep == "y"


def test_temperature_is_of_least_loss():
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 4))
    y = (x[:, 0] + r.normal(size=600) > 0).astype(float)
    net = quality.fit(x, y)
    p = net.probability(x)
    assert np.mean((p > 0.5) == y) > 0.75 and abs(p.mean() - y.mean()) < 0.08


def test_three_thousand_examples_of_a_class_are_kept(spark, docs):
    labels = spark.createDataFrame([(i, int(i < 2600)) for i in range(2800)], "doc_id bigint, toxic int")
    model = toxicity.train(docs([f"{'vile' if i < 2600 else 'calm'} creature number {i}" for i in range(2800)]), labels)
    assert model.labels.sum() == 2600


def test_repeated_rows_of_an_id_are_one_example(spark, docs, monkeypatch):
    documents, labels = labelled(spark, docs)
    more = [(i, f"other vile{i % 3} words {k % 20}") for i in (5, 70) for k in range(40)] + [(61, "you vile1 creature number 1")] * 30
    documents = documents.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True)
    ids = toxicity.train(documents, labels, least_z=3.0).ids
    assert len(ids) == len(set(ids)) and 95 <= len(ids) <= 100
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, **more: seen.append(len(x)) or fit(x, y, **more))
    quality.train(documents, labels)
    assert seen == [100]
