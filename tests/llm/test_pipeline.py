import re

import pytest

import corpus_pipeline
from millwright.llm import decontaminate
from tests.llm.test_jaccard import brute
from tests.llm.test_pii import brute as personal


@pytest.fixture
def sf(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    long = " ".join(f"the word{i % 17} and other{i} are here" for i in range(40))
    rows = [
        (1, long, "en"), (2, long, "en"), (3, long + " more", "en"), (4, None, "en"), (5, "", None), (6, "12 34 !!", "en"),
        (7, item, "en"), (8, item + " " + " ".join(f"tail{i} text" for i in range(300)), "en"), (9, "le mot et la chose sont ici avec a@b.cd ou 1.2.3.4 dans la page", "fr"),
        (10, "the mail and the note are for x.y@example.com here", "en"), (10, "the mail and the note are for x.y@example.com here", "en"), (None, "the words and the things are here", "en"),
        (11, "one text of the id that two rows have", "en"), (11, "the other text of this id is not like it at all", "en"), (None, long, "en"),
    ]
    spark.createDataFrame([(*r, "s", len(r[1] or ""), 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars int, spans int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, item


def test_stages_against_brute_force(spark, sf):
    folder, rows, item = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "encoding":
            assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        steps.append(docs.collect())
    language, near, clean, masked, encoded = steps
    assert sorted(r.doc_id or 0 for r in language) == sorted(i or 0 for i, t, _ in rows if re.search(r"[^\W\d_]", t or ""))
    distinct = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in language})
    component = [c for _, c in brute([t for *_, t in distinct], 80, 5)]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in near) == [distinct[c] for c in sorted(set(component))]
    assert {r.doc_id for r in near} - {r.doc_id for r in clean} == {7}
    assert len(masked) == len(clean)
    for r in masked:
        if r.doc_id in (None, 11):
            continue
        text = next(x.text for x in clean if x.doc_id == r.doc_id)
        for a, _, b, kind in reversed(personal(text)):
            text = text[:a] + f"<{kind}>" + text[b:]
        assert (r.text, r.n_chars) == (text, len(text))
    assert all(r.round_trip and r.n_ids > 0 for r in encoded) and len(encoded) == len(masked)
    assert decontaminate.WORD and corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, folder).count() == len(encoded)


def test_empty_table(spark, sf, tmp_path):
    folder, _, _ = sf
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.collect() == []
        empty = out
