import random
import re

import numpy as np
import pytest

from millwright.llm import jaccard


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(texts, percent=85, size=4):
    sets = [shingles(t, size) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return [(len(s), min(k for k, x in enumerate(label) if x == label[i])) for i, s in enumerate(sets)]


def families(seed, count=160):
    """Texts, most of them edited copies of a few, with passages that many share."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [r.choice(vocabulary) for _ in range(30)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([5, 20, 60, 120, 200]))] for _ in range(12)]
    texts = [None, "", "  ", "one", "One", "one two three", "a b c d", "A B C D", "a b c d e"]
    while len(texts) < count:
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            at = r.randrange(len(words))
            words[at : at + r.choice([0, 1])] = [r.choice(vocabulary)]
        if r.random() < 0.4:
            at = r.randrange(len(words))
            words[at:at] = passage
        if r.random() < 0.2:
            words += [r.choice(vocabulary) for _ in range(r.randrange(12))]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("seed, salt, cell", [(1, None, None), (2, 2, 3)])
def test_components_equal_brute_force(docs, monkeypatch, seed, salt, cell):
    if salt:  # every n-gram salted, every cell cut into parts
        monkeypatch.setattr(jaccard, "SALT_ROWS", salt)
        monkeypatch.setattr(jaccard, "CELL_ROWS", cell)
        monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 300)
    texts = families(seed)
    rows = jaccard.near_duplicates(docs(texts)).collect()
    assert len(rows) == len(texts)
    expected = brute(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(expected))


@pytest.mark.parametrize("nearest", [1, 8])
def test_a_group_of_near_copies_names_few_pairs(docs, monkeypatch, nearest):
    r = random.Random(3)
    base, texts = [f"b{i}" for i in range(200)], []
    for k in range(300):  # each is near the base; two of them are near each other or just not
        words = list(base)
        for at in r.sample(range(200), r.choice([2, 2, 3, 3])):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    monkeypatch.setattr(jaccard, "NEAREST", nearest, raising=False)
    named, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *args: named.append(pairs.count()) or verified(pairs, *args))
    rows = jaccard.near_duplicates(docs(texts), size=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(brute(texts, 80, 5)))
    assert sum(named[1:]) <= 16 * len(texts)


def joined(monkeypatch, frame):
    """The numbers of rows of all joins made from here on."""
    counts, join = [], type(frame).join

    def counted(self, *args):
        out = join(self, *args)
        counts.append(out.count())
        return out

    monkeypatch.setattr(type(frame), "join", counted)
    return counts


def roots(links):
    label = {x: x for pair in links for x in pair}
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = {x: low if y == high else y for x, y in label.items()}
    return label


@pytest.mark.parametrize("kind", ["path", "stars", "any"])
def test_components_of_links_and_of_further_links(spark, kind):
    r = random.Random(7)
    ids = r.sample(range(1000), 60)
    links = {"path": list(zip(ids, ids[1:], strict=False)), "stars": [(900 + i % 4, i) for i in range(60)], "any": [(r.choice(ids), r.choice(ids)) for _ in range(45)]}[kind]
    links += [(links[0][1], links[0][0]), links[0]]
    half = len(links) // 2
    first = jaccard.components(spark.createDataFrame(links[:half], "a bigint, b bigint"))
    both = jaccard.components(spark.createDataFrame(links[half:], "a bigint, b bigint"), first)
    for got, of in ((first, links[:half]), (both, links)):
        rows = got.collect()
        assert len(rows) == len({r.id for r in rows}) and {r.id: r.component for r in rows} == roots([x for x in of if x[0] != x[1]])


def test_links_inside_a_component_are_not_joined_again(spark, monkeypatch):
    links = [(12 * k + i, 12 * k + j) for k in range(40) for j in range(12) for i in range(j)] + [(12 * k - 1, 12 * k) for k in range(1, 40)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    counts = joined(monkeypatch, frame)
    rows = jaccard.components(frame).collect()
    assert sorted((r.id, r.component) for r in rows) == [(i, 0) for i in range(480)]
    assert sum(counts) <= 4 * len(links) + 12 * 480


def test_further_rounds_join_their_own_links_only(docs, monkeypatch):
    r = random.Random(4)
    base, texts = [f"b{i}" for i in range(200)], []
    for k in range(150):
        words = list(base)
        for at in r.sample(range(200), r.choice([2, 3])):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    counts, components, links, made = joined(monkeypatch, docs([])), jaccard.components, [], []

    def watched(found, *args):
        links.append(found.count())
        before = len(counts)
        out = components(found, *args)
        made.append(sum(counts[before:]))
        return out

    monkeypatch.setattr(jaccard, "components", watched)
    rows = jaccard.near_duplicates(docs(texts), size=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(brute(texts, 80, 5)))
    assert len(links) > 2 and links[-1] < links[1], links
    assert sum(made) <= 4 * sum(links[:2]) + 20 * len(texts), (links, made)


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (5, "a b c d e"), (5, "f g h i j"), (9, "f g h i j"), (2, None), (7, "x")]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(2, 2), (3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_empty_table(docs):
    assert jaccard.near_duplicates(docs([])).collect() == []


def test_tree_walk_equals_plain_comparison():
    r = np.random.default_rng(5)
    order = r.permutation(400).astype(np.uint64)  # the global order of the n-grams
    rank = np.argsort(order)
    base = r.choice(400, 120, replace=False)
    sets = []
    for _ in range(80):
        s = set(base[r.random(120) > r.choice([0.0, 0.03, 0.1, 0.3])].tolist()) | set(r.choice(400, r.integers(0, 12)).tolist())
        sets.append(np.array(sorted(s, key=lambda x: rank[x]), np.uint64))
    trie = jaccard.Trie(list(range(80)), sets)
    for step in (3, 128):
        for q in sets[:20]:
            got = dict(trie.matches(np.sort(q), 85, step))
            exact = {i: len(set(q.tolist()) & set(s.tolist())) for i, s in enumerate(sets)}
            assert got == {i: o for i, o in exact.items() if 100 * o >= 85 * (len(q) + len(sets[i]) - o)}


def test_bitmaps_never_differ_in_more_cells_than_the_sets():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 3, 60, 70, 130, 250)]
    sets += [np.unique(np.concatenate([s, r.integers(0, 1 << 62, 2).astype(np.uint64)])) for s in sets]
    bitmaps = [np.frombuffer(jaccard._parity(s), np.uint8) for s in sets]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    differ = jaccard._differences(bitmaps, a, b)
    assert all(d <= len(set(sets[x].tolist()) ^ set(sets[y].tolist())) for d, x, y in zip(differ, a, b, strict=True))


def test_the_driver_neither_gathers_nor_sends_the_sketch(docs, spark, monkeypatch):
    context, sent, gathered = type(spark.sparkContext), [], []
    frame = type(docs([]))
    broadcast, collect = context.broadcast, frame.collect
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(len(value)) or broadcast(self, value))
    monkeypatch.setattr(frame, "collect", lambda self: gathered.append(collect(self)) or gathered[-1])
    texts = families(5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs(texts)).collect()} == dict(enumerate(brute(texts)))
    assert not sent  # functions of more than a megabyte are broadcast
    assert sum(len(x) for rows in gathered for r in rows for x in r if isinstance(x, bytes | bytearray)) == 0
