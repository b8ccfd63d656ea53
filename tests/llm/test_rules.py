import math
import re
from collections import Counter

import pytest

from millwright.llm import rules


def brute(text):
    text = text or ""
    words, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, marked = Counter(runs), set()
    for i, run in enumerate(runs):
        if count[run] > 1:
            marked |= set(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)


TEXTS = [None, "", " \n ", "a b c d e f a b c d e", "line one\nline one\n line one\n\n\nx", "é漢😀 ##$ <a>|b", "a " * 40, "one two three four five one two three four six"]


def test_counts_equal_brute_force(docs):
    rows = rules.measure(docs(TEXTS)).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows} == {i: brute(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("k, n, p", [(0, 50, 0.02), (3, 200, 0.02), (50, 400, 0.1), (9, 10, 0.5), (10, 10, 0.5), (700, 10_000, 0.08)])
def test_binomial(k, n, p):
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))
    assert rules.binomial_cdf(k, n, p) == pytest.approx(min(1.0, exact), rel=1e-8, abs=1e-12)


def labelled(spark, good, bad):
    rows = [(i, " ".join(f"word{k * i % 97}" for k in range(1, 60)), 1) for i in range(1, good + 1)] + [(100_000 + i, "sign## " * 60 + str(i), 0) for i in range(bad)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality")


def test_enough_labels_give_cutoffs_and_few_do_not(spark):
    documents, labels = labelled(spark, 900, 60)
    rows = rules.verdicts(documents, labels.unionAll(labels.limit(5)).unionAll(spark.createDataFrame([(None, 1), (7, None)], labels.schema))).collect()
    assert len(rows) == 960
    assert sum(not r.kept for r in rows if r.doc_id < 100_000 and not r.base_failed) <= 0.02 * 900
    assert not any(r.kept for r in rows if r.doc_id >= 100_000 and not r.base_failed)
    documents, labels = labelled(spark, 40, 10)
    assert all(r.kept == (not r.base_failed) for r in rules.verdicts(documents, labels).collect())


def test_no_labels_and_no_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r.kept for r in rules.verdicts(docs([None, "a b c d e f g h i j"]), none).orderBy("doc_id").collect()] == [False, True]
    assert rules.verdicts(docs([]), none).collect() == []
