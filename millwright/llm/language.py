"""Language of every word by script and letters, and of spans by Viterbi with a penalty for switching.

The model counts byte n-grams of words (spaces as borders) for each language in a table of fixed size, summed over all
training texts. A word's score for a language is the sum of log probabilities of its n-grams. Scripts narrow the
candidates first: a word keeps only languages that write its script in training. Viterbi then labels the words of a text; changing language
costs ``penalty``. The words of many texts advance together, one step at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm import words as W
from millwright.llm.sums import sliced, summed, tune

CELLS = 1 << 15
SIZES = (2, 4)
#: The model holds CELLS x SIZES x languages numbers; more languages than this would not fit a broadcast.
MOST_LANGUAGES = 256
UNDETERMINED = "und"
LABELS = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"

# Scripts by the first byte of a character in UTF-8 (the block that the byte opens), and ASCII letters.
SCRIPTS = ("latin", "greek", "cyrillic", "armenian_hebrew", "arabic", "indic_thai_georgian", "kana_han", "hangul", "other")
_SCRIPT = np.full(256, -1, np.int8)
_SCRIPT[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5, 0xC6, 0xC7, 0xC8, 0xC9, 0xCA]] = 0
_SCRIPT[[0xCD, 0xCE, 0xCF]] = 1
_SCRIPT[[0xD0, 0xD1, 0xD2, 0xD3]] = 2
_SCRIPT[[0xD4, 0xD5, 0xD6, 0xD7]] = 3
_SCRIPT[range(0xD8, 0xDC)] = 4
_SCRIPT[[0xE0, 0xE1]] = 5
_SCRIPT[range(0xE3, 0xEA)] = 6
_SCRIPT[range(0xEA, 0xEE)] = 7
_SCRIPT[[*range(0xDC, 0xE0), *range(0xF0, 0xF5)]] = 8
_LETTER = (_SCRIPT >= 0) | (np.arange(256) >= 0x80)  # continuation bytes belong to their character


@dataclass
class Model:
    """Log probabilities by n-gram size, cell and language; which scripts each language writes."""

    languages: list[str]
    logs: np.ndarray
    writes: np.ndarray


def _cells(data: np.ndarray, offsets: np.ndarray):
    """Words (starts, ends, first of each text) and, for the bytes of words one after another, the cells of the n-grams they end."""
    data = W.lower(data)
    starts, ends, first = W.spans(data, offsets, _LETTER)
    inner = data[_LETTER[data]].astype(np.uint32)
    lengths = ends - starts
    place = np.arange(len(inner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = []
    for size in SIZES:
        h = np.zeros(len(inner), np.uint32)
        for k in range(size):
            before = np.zeros(len(inner), np.uint32)
            before[k:] = inner[: len(inner) - k]
            before[place < k] = 0  # the border
            h = h * np.uint32(0x01000193) + before + np.uint32(1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append(((h ^ (h >> np.uint32(13))) & np.uint32(CELLS - 1)).astype(np.int32))
    return starts, ends, first, out, np.cumsum(lengths) - lengths


def _script(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    script = _SCRIPT[data[starts]].astype(np.int64)
    return np.where(script < 0, len(SCRIPTS) - 1, script)


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all ``rows`` whose language is not null."""
    tune(rows.sparkSession)
    rows = rows.where(F.col(lang).isNotNull()).select(text, lang)
    languages = sorted(r[0] for r in rows.select(lang).distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the model would not fit a broadcast")
    number = {name: k for k, name in enumerate(languages)}
    shape = (len(SIZES) * CELLS + len(SCRIPTS), max(1, len(languages)))

    def task(batches):
        total = np.zeros(shape, np.int64)
        for batch in batches:
            own = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for low, high, data, offsets in W.texts(batch.column(0)):
                starts, ends, first, cells, _ = _cells(data, offsets)
                word_lang = own[low:high][W.owners(first)]
                byte_lang = np.repeat(word_lang, ends - starts)
                for k, c in enumerate(cells):
                    part = total[k * CELLS : (k + 1) * CELLS].reshape(-1)
                    part += np.bincount(c.astype(np.int64) * shape[1] + byte_lang, minlength=len(part))
                part = total[len(SIZES) * CELLS :].reshape(-1)
                part += np.bincount(_script(data, starts) * shape[1] + word_lang, minlength=len(part))
        yield from sliced(total)

    total = summed(rows, task, shape, np.int64).astype(np.float64)
    grams, scripts = total[: len(SIZES) * CELLS].reshape(len(SIZES), CELLS, shape[1]), total[len(SIZES) * CELLS :].T
    logs = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * CELLS)) / len(SIZES)
    writes = scripts >= 0.001 * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, logs.astype(np.float32), writes)


def _word_scores(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cells: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
    """Log likelihood of each word in each language, after scripts have narrowed the languages."""
    count = len(model.languages)
    out = np.zeros((len(starts), count), np.float32)
    lengths, limit, at = ends - starts, max(1, (1 << 22) // count), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(begins, begins[at] + limit)))
        low, high = int(begins[at]), int(begins[to - 1] + lengths[to - 1])
        part = sum(model.logs[k][c[low:high]] for k, c in enumerate(cells))
        out[at:to] = np.add.reduceat(part, begins[at:to] - low, axis=0)
        at = to
    allowed = model.writes[:, _script(data, starts)].T
    return np.where(allowed | ~allowed.any(axis=1, keepdims=True), out, out - 50)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best state of each word, given its scores, the first word of each text, and the cost of a change of state."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, length = first[:-1][order], lengths[order]
    back = np.zeros(scores.shape, np.uint8)
    states = np.arange(scores.shape[1], dtype=np.uint8)
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), "left").tolist()
    for t, n in enumerate(active):
        at = begin[:n] + t
        now = best[:n]
        if t:
            top = now.argmax(axis=1)
            switched = now[np.arange(n), top][:, None] - penalty
            stays = now >= switched
            back[at] = np.where(stays, states, top[:, None].astype(np.uint8))
            now = np.where(stays, now, switched)
        best[:n] = now + scores[at]
    state = best.argmax(axis=1)
    out = np.zeros(len(scores), np.int64)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        out[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return out


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def identify(documents: DataFrame, model: Model, text: str = "text", penalty: float = 8.0) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` and ``spans``; columns of these names are replaced.

    ``spans`` are character positions, end exclusive, in order; a span runs from its first word to the end of its last.
    ``lang_pred`` is the language of most letters (of equals the first by name), ``score`` the mean of its share of them and of
    its probability against the other languages over the whole text. Null texts, texts without a letter, and all texts when
    no language was learnt are ``und`` with score 0 and no spans.
    """
    tune(documents.sparkSession, 2000)
    kept = [c for c in documents.columns if c not in ("lang_pred", "score", "spans")]
    schema = documents.select(kept).schema
    for field in T.StructType.fromDDL(LABELS):
        schema = schema.add(field)
    languages, place = model.languages, kept.index(text)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def label(column: pa.Array):
        """Language, score and spans of each text of a batch."""
        parts = []
        for _, _, data, offsets in W.texts(column):
            starts, ends, first, cells, begins = _cells(data, offsets)
            places = np.cumsum((data & 0xC0) != 0x80)  # characters up to each byte
            base = np.concatenate([[0], places])[offsets[:-1]][W.owners(first)]
            parts.append((np.diff(first), _word_scores(model, data, starts, ends, cells, begins), places[starts] - 1 - base, places[ends - 1] - base))
        counts, scores, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
        first = np.concatenate([[0], np.cumsum(counts)])
        state = viterbi(scores, first, penalty)
        doc = W.owners(first)
        letters = np.bincount(doc * len(languages) + state, weights=high - low, minlength=len(counts) * len(languages)).reshape(len(counts), -1)
        total = np.zeros((len(counts), len(languages)))
        for k in range(len(languages)):
            total[:, k] = np.bincount(doc, weights=scores[:, k], minlength=len(counts))
        winner = letters.argmax(axis=1)
        rows = np.arange(len(counts))
        sure = 1 / np.exp(np.minimum(total - total[rows, winner][:, None], 50)).sum(axis=1)
        share = letters[rows, winner] / np.maximum(1, letters.sum(axis=1))
        changes = np.ones(len(state), bool)
        changes[1:] = (state[1:] != state[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(changes)
        last = np.append(at, len(state))[1:] - 1
        spans = [[] for _ in counts]
        for d, a, b, s in zip(doc[at].tolist(), low[at].tolist(), high[last].tolist(), state[at].tolist(), strict=True):
            spans[d].append({"start": a, "end": b, "lang": languages[s]})
        return counts, [languages[w] for w in winner], ((share + np.minimum(1, sure)) / 2).tolist(), spans

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(place)
            if languages:
                counts, names, scores, spans = label(column)
            else:
                counts, names, scores, spans = np.zeros(batch.num_rows, int), [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows, [[]] * batch.num_rows
            names, scores, spans = list(names), list(scores), list(spans)
            for i in range(batch.num_rows):
                if not counts[i] or not _has_letter(column[i].as_py()):
                    names[i], scores[i], spans[i] = UNDETERMINED, 0.0, []
            values = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], [*kept, "lang_pred", "score", "spans"])

    return documents.select(kept).mapInArrow(task, schema)


def held_out(key: str, parts: int, part: int):
    """Whether crc32 of the key as text leaves ``part``; a null key is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))
