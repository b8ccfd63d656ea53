import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from millwright.llm import decontaminate as D


def words(text):
    return re.findall(D.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=13):
    w, hit, names = words(text), set(), set()
    for item_id, item in items:
        x = words(item)
        size = min(window, len(x))
        for k in range(len(x) - size + 1 if x else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == x[k : k + size]:
                    hit |= set(range(i, i + size))
                    names |= {str(item_id)} if item_id is not None else set()
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = ["The", "of", "a", "Ünder", "x1", "y", "z-", "q_r", "漢字"]
    make = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, make(r.choice([1, 3, 12, 13, 14, 40]) if i else 60)) for i in range(8)]
    items += [(8, None), (9, ""), (10, "--"), (None, make(20)), (3, items[3][1]), (11, items[0][1]), (12, "rare words here")]
    texts = [None, "", "- -", items[0][1], "rare words here", "Rare, WORDS! here?", "rare words", items[0][1] * 2]
    for _ in range(30):
        text = make(r.randrange(120))
        piece = words(r.choice(items[:8])[1])
        texts.append(text + " " + " ".join(piece[r.randrange(len(piece)) :]) + " " + make(r.randrange(300)))
    return items, texts


@pytest.mark.parametrize("shard", [2_000_000, 20])
def test_hits_equal_brute_force(spark, docs, shard):
    items, texts = corpus(1)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.digest(D.contamination(docs(texts), benchmark, shard_words=shard)).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
    assert got == {i: brute(t, items) for i, t in enumerate(texts)}


def test_automaton_tracks_the_longest_match():
    r = random.Random(2)
    items = [[r.randrange(3) for _ in range(r.randrange(1, 9))] for _ in range(6)]
    automaton = D.Automaton()
    for x in items:
        automaton.add(x)
    factors = {tuple(x[a:b]) for x in items for a in range(len(x)) for b in range(a, len(x) + 1)}
    text = [r.randrange(4) for _ in range(300)]
    expected = [max(n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in factors or n == 0) for i in range(len(text))]
    assert list(automaton.read(text)) == expected


def test_shards_hold_every_text_once_with_all_its_names(spark):
    items = [(i, f"item {i % 40} " + "word " * 30) for i in range(120)] + [(None, "no name"), (7, None), (8, "")]
    folders = D.shards(spark.createDataFrame(items, "item_id bigint, text string"), 200)
    held = [D._items(folder) for folder in folders]
    assert len(folders) > 5 and all(held)
    got = {text: sorted(names) for shard in held for names, text in shard}
    assert sum(map(len, held)) == len(got) == 41
    assert got["no name"] == [] and got[items[5][1]] == ["45", "5", "85"]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    row = D.digest(D.contamination(docs(["a b"]), none)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert D.digest(D.contamination(docs([]), none)).collect() == []


def test_removal():
    assert D.without_hits("One, two three four.", [(1, 3)]) == "One,  four."
    assert np.array_equal(D._merge([(4, 6), (0, 2), (2, 3)]), [{"start": 0, "end": 3}, {"start": 4, "end": 6}])


@pytest.mark.parametrize("shard", [2_000_000, 20])
def test_passages_are_cut_out_of_documents_that_stay(spark, docs, shard):
    item, short = " ".join(f"w{i}" for i in range(14)), "Ünder the bridge"
    tail = " ".join(f"tail{i} text" for i in range(300))
    texts = [None, "", tail, f"{item} {tail}", f"Über: ({item.upper()}), {tail} ÜNDER the, bridge!", item, f"under the {item} bridge {tail} Ünder {item} the bridge", f"{short} {item}"]
    benchmark = spark.createDataFrame([(1, item), (2, short)], "item_id bigint, text string")
    out = D.without_passages(docs(texts), benchmark, shard_words=shard)
    assert out.columns == docs(texts).columns
    got = {r.doc_id: r.text for r in out.collect()}
    # text 6 has a passage inside another one: what is left of the outer joins, and goes too
    assert got == {0: None, 1: "", 2: tail, 3: f" {tail}", 4: f"Über: (), {tail} !", 6: f"under the  bridge {tail} "}


def test_no_passage_reaches_the_encoding(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(20))
    text = f"{item} " + " ".join(f"tail{i} text" for i in range(300))
    spark.createDataFrame([(1, text, "s", len(text))], "doc_id bigint, text string, hit_runs string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    row = corpus_pipeline.decontaminate_benchmark(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).first()
    assert (row.text, row.hit_runs, row.n_chars) == (text[len(item) :], "s", len(text) - len(item))
