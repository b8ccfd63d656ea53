import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from millwright.llm import merkle

SHAPE = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, at string, tree string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climbed(digests, run):
    """Levels of a tree, and a climb of a place: its siblings and the path's places."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + run])) for i in range(0, len(levels[-1]), run)])
    return levels


def folded(levels, at, shown, run):
    siblings = ""
    for level in levels[:-1]:
        start = at - at % run
        before, after = "".join(level[start:at]), "".join(level[at + 1 : start + run])
        siblings, shown, at = siblings + before + after, h(before + shown + after), at // run
    return siblings, shown


def expected(rows, run):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, h("".join(map(enc, r[:5])))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = climbed([leaf for _, leaf in groups[g]], run)
    upper = climbed([trees[g][-1][0] for g in order], run)
    out = []
    for k, g in enumerate(order):
        for at, (r, leaf) in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            shown = h("".join(map(enc, (*r[:3], r[3] + 1, r[4])))) if tampered else leaf
            low, subroot = folded(trees[g], at, shown, run)
            high, root = folded(upper, k, subroot, run)
            out.append((r[0], leaf, trees[g][-1][0], upper[-1][0], h(low + high), root, root == upper[-1][0]))
    return sorted(out, key=repr)


def rows(count, langs):
    return [(i, f"s{i % 3}" if i % 5 else None, langs[i % len(langs)], i if i % 4 else None, ("é" * (i % 7)) if i % 6 else None, "x", "y", "z") for i in range(count)]


def verify(spark, data, **shape):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted((tuple(r) for r in merkle.verify(spark.createDataFrame(data, SHAPE), tampered, **shape).collect()), key=repr)


@pytest.mark.parametrize(("run", "height", "count"), [(2, 10, 300), (2, 2, 77), (3, 2, 100), (2, 1, 9)])
def test_against_a_plain_tree(spark, run, height, count):
    data = rows(count, ["en", None, "fr", "é", "Z"])
    assert verify(spark, data, run=run, height=height) == expected(data, run)


def test_every_language_alone_and_one_language(spark):
    data = rows(19, [f"l{i}" for i in range(19)])
    assert verify(spark, data, height=2) == expected(data, 2)
    data = rows(1, ["en"])
    assert verify(spark, data) == expected(data, 2)


def test_repeated_rows_and_null_ids(spark):
    data = rows(6, ["en"]) * 5 + [(3, "other", "en", 1, "t", "", "", "")] * 2 + [(None, None, None, None, None, "", "", "")] * 3
    assert verify(spark, data, height=2) == expected(data, 2)


def test_a_long_text(spark):
    data = rows(5, ["en"]) + [(9, "s", "en", 1, "ab é" * 500_000, "", "", "")]
    assert verify(spark, data) == expected(data, 2)


def test_nodes_above_many_leaves_are_copied(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SHARE", 4)
    data = rows(60, ["en", "fr"])
    assert verify(spark, data, height=2) == expected(data, 2)


def test_empty_table(spark):
    assert verify(spark, []) == []
