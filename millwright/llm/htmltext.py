"""Main text of web pages by a tree-structured graphical model over the document's elements.

Every block element and every block of text is a node that is main text or not. A node has a weight for each of its
features: element, names, amount of text, links, punctuation, place in the page. An edge from parent to child has a potential
for each pair of labels and kind of child. One pass of sum-product messages from the leaves up and one from the root down
give the exact marginal of every node. Weights and potentials follow the gradient of the labelled pages' likelihood, whose
expectations are these marginals. Text blocks whose marginal is a half or more are the main text.

Parts whose element alone puts them outside (``OUTSIDE``, a ``header`` that is in no article, a form around less than half
of the page's text) are observed as such, with all they hold.

Labelled pages are drawn layouts (``examples``) and at most ``pages`` distinct pages of the corpus, of at most ``longest``
characters each, that have exactly one ``article`` or ``main`` element: what it holds is main text, save parts named as others.

A null, empty or textless page has an empty text. White space is what Unicode calls so, no-break spaces included. Rows that
repeat an id are pages of their own; a table without pages has no rows and learns from layouts alone.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm import dom, examples, sums

#: Elements that the article is without, by their meaning.
OUTSIDE = frozenset("nav aside footer button select optgroup option dialog search".split())
KINDS = ("text", "flow", "list", "box")
_FLOW = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption caption td th dt dd".split())
_LIST = frozenset("ul ol li dl table tbody thead tfoot tr menu".split())
STEPS, RATE, DECAY = 300, 0.08, 1e-5
BATCH_NODES = 40_000


def kind_of(tag: str) -> int:
    return 0 if not tag else 1 if tag in _FLOW else 2 if tag in _LIST else 3


def _bucket(value: float, edges: Sequence[float]) -> int:
    return sum(value >= e for e in edges)


def described(page: dom.Page) -> tuple[list[list[str]], list[bool]]:
    """The features of each node, and whether the node is observed as outside."""
    count = len(page.parent)
    chars, linked, marks, before = [0] * count, list(page.linked), [0] * count, [0] * count
    total = 0
    for i in range(count):
        before[i] = total
        if page.text[i]:
            chars[i] = len(page.text[i])
            marks[i] = sum(map(page.text[i].count, ".!?。！？।؟"))
            total += chars[i]
    blocks = [1 if t else 0 for t in page.text]
    for i in range(count - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        marks[p] += marks[i]
        blocks[p] += blocks[i]
    total = total or 1
    features, out, article = [], [False] * count, [False] * count
    for i in range(count):
        p, tag = page.parent[i], page.tag[i]
        article[i] = tag in ("article", "main") or p >= 0 and article[p]
        out[i] = (
            p >= 0 and out[p] or tag in OUTSIDE or tag == "header" and not article[p] or tag == "form" and 2 * chars[i] < total)
        k = kind_of(tag)
        own = [f"{KINDS[k]}", f"{KINDS[k]} chars {_bucket(chars[i], (1, 20, 60, 160, 400, 1200))}", f"{KINDS[k]} links {_bucket(linked[i] / (chars[i] or 1), (0.01, 0.25, 0.6))}"]
        own.append(f"{KINDS[k]} marks {_bucket(100 * marks[i] / (chars[i] or 1), (0.01, 0.8, 2.5))}")
        if tag:
            own += [f"<{tag}>", f"{KINDS[k]} share {_bucket(chars[i] / total, (0.05, 0.2, 0.5, 0.9))}", f"{KINDS[k]} blocks {_bucket(blocks[i], (1, 2, 4, 8))}"]
            own.append(f"{KINDS[k]} place {_bucket((before[i] + chars[i] / 2) / total, (0.1, 0.3, 0.7, 0.9))}")
            own += [f".{w}" for w in page.names[i]]
        else:
            above = page.tag[p]
            own += [f"in <{above}>", f"in <{page.tag[page.parent[p]] if p else ''}> <{above}>", "ends" if page.text[i][-1] in ".!?。！？।؟:" else "no end"]
            if "©" in page.text[i]:
                own.append("©")
        features.append(own)
    return features, out


class Forest:
    """Nodes of several pages, by depth. ``of`` is the page of a node, ``node`` its number there."""

    def __init__(self, pages: Sequence[dom.Page], names: dict[str, int]) -> None:
        sizes = [len(p.parent) for p in pages]
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.first, self.sizes = first, sizes
        parent, depth, kind, out, ids, ends = [], [], [], [], [], [0]
        for base, page in zip(first, pages, strict=True):
            features, outside = described(page)
            parent += [base + p for p in page.parent]
            depth += page.depth
            kind += map(kind_of, page.tag)
            out += outside
            for own in features:
                ids += [names[f] for f in own if f in names]
                ends.append(len(ids))
        self.parent, self.kind, self.out = np.array(parent, np.int64), np.array(kind, np.int64), np.array(out, bool)
        self.ids, self.ends = np.array(ids, np.int64), np.array(ends, np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(order) else []
        self.out[first.astype(int)] = True

    def unary(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.ids])])
        return np.where(self.out, -40.0, total[self.ends[1:]] - total[self.ends[:-1]])

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the probability of main text, and of each edge those of the parent's and the child's labels."""
        count = len(unary)
        upward, message, belief = np.zeros((count, 2)), np.zeros((count, 2)), np.zeros((count, 2))
        upward[:, 1] = unary
        for nodes in reversed(self.levels[1:]):
            both = upward[nodes][:, None, :] + pair[self.kind[nodes]]
            message[nodes] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(upward, self.parent[nodes], message[nodes])
        edges = np.zeros((count, 2, 2))
        belief[self.levels[0]] = upward[self.levels[0]]
        for nodes in self.levels[1:]:
            without = belief[self.parent[nodes]] - message[nodes]
            both = without[:, :, None] + pair[self.kind[nodes]]
            belief[nodes] = upward[nodes] + np.logaddexp(both[:, 0], both[:, 1])
            both = both + upward[nodes][:, None, :]
            both = np.exp(both - both.max((1, 2), keepdims=True))
            edges[nodes] = both / both.sum((1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), edges


class Model:
    def __init__(self, names: dict[str, int], weights: np.ndarray, pair: np.ndarray) -> None:
        self.names, self.weights, self.pair = names, weights, pair

    def blocks(self, pages: Sequence[dom.Page]) -> list[list[tuple[str, float]]]:
        """The text blocks of each page, in order, with their marginals."""
        forest = Forest(pages, self.names)
        p, _ = forest.marginals(forest.unary(self.weights), self.pair)
        return [[(t, float(p[base + i])) for i, t in enumerate(page.text) if t] for base, page in zip(forest.first, pages, strict=True)]


def marked(page: dom.Page) -> np.ndarray:
    """Labels of a layout: a node has the mark of the nearest part around it."""
    labels = np.zeros(len(page.parent), bool)
    for i in range(1, len(labels)):
        labels[i] = page.mark[i] == "1" if page.mark[i] is not None else labels[page.parent[i]]
    return labels


def told(page: dom.Page) -> np.ndarray | None:
    """Labels of a page by its one ``article`` or ``main``, without parts that are named as others; None where it has none or several."""
    if sum(t in ("article", "main") for t in page.tag) != 1:
        return None
    labels, beside = np.zeros(len(page.parent), bool), [False] * len(page.parent)
    for i in range(1, len(labels)):
        p = page.parent[i]
        beside[i] = beside[p] or labels[p] and not examples.BESIDE.isdisjoint(page.names[i])
        labels[i] = not beside[i] and (page.tag[i] in ("article", "main") or labels[p])
    return labels


def fit(pages: Sequence[dom.Page], labels: Sequence[np.ndarray]) -> Model:
    """Weights by the gradient of the log likelihood: what the labels have of each feature less what the marginals expect."""
    seen = Counter(f for page in pages for own in described(page)[0] for f in set(own))
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3))}
    forest = Forest(pages, names)
    truth = np.concatenate(labels) & ~forest.out
    inner = np.setdiff1d(np.arange(len(truth)), forest.first)
    observed = np.zeros((len(KINDS), 2, 2))
    np.add.at(observed, (forest.kind[inner], truth[forest.parent[inner]].astype(int), truth[inner].astype(int)), 1.0)
    owner = np.repeat(np.arange(len(truth)), np.diff(forest.ends))
    weights, pair = np.zeros(len(names)), np.zeros((len(KINDS), 2, 2))
    mean, spread = [np.zeros_like(weights), np.zeros_like(pair)], [np.zeros_like(weights), np.zeros_like(pair)]
    for t in range(1, STEPS + 1):
        p, edges = forest.marginals(forest.unary(weights), pair)
        rest = np.where(forest.out, 0.0, truth - p)
        expected = np.zeros_like(observed)
        np.add.at(expected, forest.kind[inner], edges[inner])
        steps = [np.bincount(forest.ids, rest[owner], len(names)) / len(truth) - DECAY * weights, (observed - expected) / len(truth) - DECAY * pair]
        for k, (value, step) in enumerate(zip((weights, pair), steps, strict=True)):
            mean[k] = 0.9 * mean[k] + 0.1 * step
            spread[k] = 0.99 * spread[k] + 0.01 * step**2
            value += RATE * (mean[k] / (1 - 0.9**t)) / (np.sqrt(spread[k] / (1 - 0.99**t)) + 1e-9)
    return Model(names, weights, pair)


@functools.cache
def _drawn(count: int) -> tuple[list[dom.Page], list[np.ndarray]]:
    pages = [dom.parse(html) for html in examples.layouts(count)]
    return pages, [marked(p) for p in pages]


def train(pages: DataFrame, limit: int = 200, longest: int = 200_000, drawn: int = 500) -> Model:
    """A model of ``drawn`` layouts and at most ``limit`` distinct labelled ``pages``, those first in an order of hashes."""
    html = pages.select("html").where(F.length("html").between(1, longest) & F.col("html").rlike("(?i)<(article|main)[\\s>]")).withColumn("h", F.xxhash64("html"))
    first = [r.h for r in html.select("h").distinct().orderBy("h").limit(limit).collect()]
    texts = html.where(F.col("h").isin(first)).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if first else []
    parsed = [dom.parse(r.html) for r in texts]
    known = [(p, t) for p in parsed if (t := told(p)) is not None]
    layouts, labels = _drawn(drawn)
    return fit([*layouts, *(p for p, _ in known)], [*labels, *(t for _, t in known)])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept``: the main text of every page, its length in code points, and text blocks in all and kept."""

    def rows(html: list[str | None]):
        held, nodes = [], 0
        for k, source in enumerate(html):
            held.append(dom.parse(source or ""))
            nodes += len(held[-1].parent)
            if nodes >= BATCH_NODES or k == len(html) - 1:
                for blocks in model.blocks(held):
                    kept = [t for t, p in blocks if p >= 0.5]
                    yield " ".join(kept), len(blocks), len(kept)
                held, nodes = [], 0

    def task(batches):
        for batch in batches:
            found = list(rows(batch.column(2).to_pylist()))
            if found:
                text, blocks, kept = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(text, pa.string()), "n_chars": pa.array(map(len, text), pa.int64()),
                    "n_blocks": pa.array(blocks, pa.int64()), "n_kept": pa.array(kept, pa.int64())})

    sums.tune(pages.sparkSession, 64)
    page_id = pages.schema["page_id"].dataType.simpleString()
    own = pages.select("page_id", F.col("url").cast("string"), "html")
    return own.mapInArrow(task, f"page_id {page_id}, url string, text string, n_chars bigint, n_blocks bigint, n_kept bigint")
