import re

import numpy as np
import pyarrow as pa
import pytest

from millwright.llm import words as W

TEXTS = ["Hello  World", "", None, "a b\tc Hello", "é è\nHello 漢 😀x", " ", "x", "World", "end ", " start"]


@pytest.mark.parametrize("accepted, pattern", [(W.SPACED, r"[^\x20\x09-\x0D]+"), (W.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")])
def test_words_of_each_text(accepted, pattern):
    seen = []
    for low, high, data, offsets in W.texts(pa.array(TEXTS)):
        starts, ends, first = W.spans(data, offsets, accepted)
        for d in range(high - low):
            seen.append([bytes(data[a:b]).decode() for a, b in zip(starts[first[d] : first[d + 1]], ends[first[d] : first[d + 1]], strict=True)])
    assert seen == [re.findall(pattern, t or "") for t in TEXTS]


def test_equal_words_and_only_these_have_equal_hashes(monkeypatch):
    text = " ".join(["ab", "ba", "abab", "a", "ab", "x" * 300, "x" * 301, "x" * 300, "ü", "u"])
    for block in (1 << 20, 64):  # 64: words longer than a block
        monkeypatch.setattr(W, "BLOCK", block)
        W._cache.clear()
        (_, _, data, offsets), = W.texts(pa.array([text]))
        h = W.hashes(data, *W.spans(data, offsets, W.SPACED)[:2]).tolist()
        words = text.split(" ")
        assert [[a == b for a in h] for b in h] == [[a == b for a in words] for b in words]
    W._cache.clear()


def test_slices_of_columns_and_long_texts():
    column = pa.array(["a b", None, "c " * 2_000_000, "d"])[1:]
    counts = []
    for _, _, data, offsets in W.texts(column):
        counts += np.diff(W.spans(data, offsets, W.SPACED)[2]).tolist()
    assert counts == [0, 2_000_000, 1]


def test_windows():
    h = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    w = W.windows(h, 3).tolist()
    assert w[0] == w[3] and len(set(w)) == 3 and len(W.windows(h, 7)) == 0
