import os
import random

import numpy as np
import pytest

from millwright.llm import pieces
from millwright.llm.queries import PIECES

pytestmark = pytest.mark.skipif(not os.path.exists(PIECES), reason="no tokenizer file")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PIECES)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def texts():
    r = random.Random(1)
    letters = "ab the  ing \n\t é漢😀ñ ion123.,▁<s>"
    out = ["".join(r.choice(letters) for _ in range(r.randint(0, 200))) for _ in range(300)]
    return out + ["a" * 3000, " " * 2000, "the" * 1000, "", " ", "  x", "x  ", "thethingthatandthe" * 200, "<s></s><0x0A>", "Hello  World\n a\t éß漢 "]


def test_ids_equal_the_library(vocabulary, library):
    encoder = pieces.Encoder(vocabulary)
    got = [np.frombuffer(x, np.int32).tolist() for x in encoder.encode_many(texts())]
    assert got == library.encode(texts())
    one_by_one = [[i for part in encoder.cuts(t) for _, ids in encoder.stream(part) for i in ids] for t in texts()]
    assert one_by_one == got


def test_the_window_stays_bounded(vocabulary):
    encoder, before = pieces.Encoder(vocabulary), 0
    for at, _ in encoder.stream("thingsandothe" * 2000):
        assert at - before <= 4 * encoder.longest
        before = at
    assert before == 26_000


def test_a_small_cache_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 20)
    monkeypatch.setattr(pieces._Lockstep, "SLOTS", 64)
    encoder = pieces.Encoder(vocabulary)
    monkeypatch.setattr(pieces._Lockstep, "_slot", lambda self, keys: keys % 64)
    for t in texts()[:60]:
        assert np.frombuffer(encoder.encode(t), np.int32).tolist() == library.encode(t)


def test_round_trip_on_spark(docs, vocabulary):
    own = [None, *texts()]
    encoded = pieces.encode(docs(own), vocabulary)
    back = pieces.decode(encoded, vocabulary, into="back").orderBy("doc_id").collect()
    assert [r.back for r in back] == [(t or "").replace("▁", " ") for t in own]
    assert all(r.round_trip and r.n_ids == len(r.ids) and r.n == "z" for r in back)
    assert pieces.encode(docs([]), vocabulary).collect() == []
