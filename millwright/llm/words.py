"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes that a 256-entry table accepts; every table here accepts or refuses whole characters, so
byte runs are character runs. Words are compared by a 64-bit polynomial hash of their bytes. Two different words of one
comparison collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_cache: dict[str, np.ndarray] = {}

#: Bytes of words between spaces: all but 0x20 and 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte value; the multiplier's powers and their inverses modulo 2**64."""
    if not _cache:
        noise = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for name, base in (("powers", _MULTIPLIER), ("inverses", inverse)):
            factors = np.full(BLOCK + 1, base, np.uint64)
            factors[0] = 1
            _cache[name] = np.cumprod(factors, dtype=np.uint64)
        _cache["noise"] = noise
    return _cache["noise"], _cache["powers"], _cache["inverses"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, row after the last, bytes, offsets), of ``BLOCK`` bytes unless a text is longer.

    A null counts as an empty text.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def spans(data: np.ndarray, offsets: np.ndarray, accepted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where words start and end, and for each text (and the end) the number of its first word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = accepted[data]
    edges = offsets[1:-1]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    within = edges[(edges > 0) & (edges < len(data))]
    opens[within] = inside[within + 1]
    closes[within - 1] = inside[within]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; the spans follow one another."""
    noise, powers, inverses = _tables()
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        if ends[at] - base > BLOCK:
            total = 0
            for k, low in enumerate(range(base, int(ends[at]), BLOCK)):
                part = data[low : min(low + BLOCK, int(ends[at]))]
                total += int((noise[part] * powers[: len(part)]).sum(dtype=np.uint64)) * pow(_MULTIPLIER, k * BLOCK, 1 << 64)
            out[at], to = np.uint64(total & _MASK), at + 1
        else:
            part = data[base : int(ends[to - 1])]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(noise[part] * powers[: len(part)], out=sums[1:])
            low = starts[at:to] - base
            out[at:to] = (sums[ends[at:to] - base] - sums[low]) * inverses[low]
        at = to
    return mix(out)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` neighbours."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    count = len(h) - n + 1
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * np.uint64(_MULTIPLIER) + h[k : k + count]
    return mix(out)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
