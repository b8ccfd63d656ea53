import itertools
import zlib

import numpy as np

from millwright.llm import language

SAMPLES = [("the cat sat on the mat and the dog was there with them", "en"), ("le chat est sur la table avec le chien de la maison", "fr"), ("кошка сидит на столе и собака рядом", "ru"), ("gone", None)]


def model_of(spark):
    return language.train(spark.createDataFrame(SAMPLES, "text string, lang string"))


def test_spans_of_mixed_text_and_undetermined_texts(spark, docs):
    text = "the dog and the cat le chien est sur la table avec кошка сидит на столе"
    texts = [text, None, "", "123 -- !", "—«»", "the", "the"]
    rows = language.identify(docs(texts), model_of(spark), penalty=2.0).orderBy("doc_id").collect()
    assert [(text[s.start : s.end], s.lang) for s in rows[0].spans] == [("the dog and the cat", "en"), ("le chien est sur la table avec", "fr"), ("кошка сидит на столе", "ru")]
    assert [(r.lang_pred, r.score, r.spans) for r in rows[1:5]] == [("und", 0.0, [])] * 4
    assert rows[5].lang_pred == rows[6].lang_pred == "en" and 0 < rows[5].score <= 1
    assert rows[0].rep == "y"  # columns of the input stay


def test_viterbi_equals_all_paths():
    random = np.random.default_rng(3)
    lengths = [0, 1, 5, 3, 6, 6]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = random.normal(0, 2, (first[-1], 3)).astype(np.float32)
    got = language.viterbi(scores, first, 1.5)
    for a, b in zip(first[:-1], first[1:], strict=True):
        value = lambda p: sum(scores[a + i, s] for i, s in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:], strict=False))  # noqa: B023, E731
        if b > a:
            assert tuple(got[a:b]) == max(itertools.product(range(3), repeat=b - a), key=value)


def test_no_language_learnt(spark, docs):
    model = language.train(docs(["a"]))
    assert [r.lang_pred for r in language.identify(docs(["a b", None]), model).collect()] == ["und", "und"]


def test_held_out_is_the_checksum_of_the_id_as_text(spark):
    rows = spark.range(-50, 50).select("id", language.held_out("id", 4, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_accuracy_on_held_out_documents(spark):
    from millwright.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = QUERIES["op2_language_id"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, count = got.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert count > 20 and right >= 0.97 * count
