"""Quality rules whose cutoffs keep the share of good texts they reject below a limit, with a stated confidence.

Every text is measured once. Of the labelled rows, one half by a hash of the id proposes cutoffs: for each stratum and
each level, the values that this share of its good texts exceeds, one per measure. The other half tests the levels from
the loosest to the strictest. A level passes while the chance of seeing so few good texts rejected, if the true share
were the limit, is at most ``alpha`` divided by the number of strata (an exact binomial bound). Testing stops at the
first level that does not pass, which holds the chance of any wrong cutoff in any stratum to ``alpha``. Strata with too few labels
for any level reject nothing.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm import words as W
from millwright.llm.sums import tune
from millwright.session import cut

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_echoes", "n_plain")
STRATA = 8
#: A cutoff stands so far above the value it is taken from.
MARGINS = {"symbols": 0.02, "bangs": 0.02, "upper": 0.05, "dup_lines": 0.05, "repeats": 0.02, "echoes": 0.02, "word_length": 0.5}
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.008, 0.015)

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LINE = np.ones(256, bool)
_LINE[0x0A] = False


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, before


def _measure_block(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``COUNTS`` of each text as columns."""
    docs = len(offsets) - 1

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, first = W.spans(data, offsets, W.SPACED)
    h, doc = W.hashes(data, starts, ends), W.owners(first)
    salt = W.mix(doc.astype(np.uint64) + np.uint64(1))
    character = (data < 0x80) | (data >= 0xC0)
    lines, line_ends, line_first = W.spans(data, offsets, _LINE)
    has_word = np.searchsorted(starts, lines) < np.searchsorted(starts, line_ends)
    line_doc = W.owners(line_first)
    _, before = _again((W.hashes(data, lines, line_ends) ^ W.mix(line_doc.astype(np.uint64) + np.uint64(1)))[has_word])
    repeats = np.zeros(len(h), bool)
    if len(h) >= 5:
        own = doc[4:] == doc[:-4]
        twice, _ = _again((W.windows(h, 5) ^ salt[:-4])[own])
        change = np.zeros(len(h) + 1, np.int64)
        at = np.flatnonzero(own)[twice]
        np.add.at(change, at, 1)
        np.add.at(change, at + 5, -1)
        repeats = np.cumsum(change[:-1]) > 0
    echo = np.zeros(len(h), bool)
    echo[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    plain = W.ALNUM[data]
    return np.stack([
        np.diff(first), per_text(W.SPACED[data] & character), per_text(_SYMBOLS[data]),
        np.bincount(line_doc[has_word][before], minlength=docs), np.bincount(doc[repeats], minlength=docs),
        np.bincount(line_doc[has_word], minlength=docs), per_text((data >= 65) & (data <= 90)), per_text(data == 0x21),
        np.bincount(doc[echo], minlength=docs), per_text(plain & character),
    ], axis=1)


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``COUNTS`` (columns of these names are replaced). A null text counts as an empty one."""
    tune(documents.sparkSession)
    kept = [c for c in documents.columns if c not in COUNTS]
    schema = documents.select(kept).schema
    for name in COUNTS:
        schema = schema.add(T.StructField(name, T.LongType()))

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = np.concatenate([_measure_block(data, offsets) for _, _, data, offsets in W.texts(batch.column(kept.index(text)))])
            columns = [*batch.columns, *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in counts.T)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *COUNTS])

    return documents.select(kept).mapInArrow(task, schema)


def measures() -> dict[str, Column]:
    """What the rules compare, the larger the worse."""
    words, lines, plain = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "n_lines", "n_plain"))
    return {
        "symbols": F.col("n_symbols") / words, "bangs": F.col("n_bangs") / words, "upper": F.col("n_upper") / plain,
        "dup_lines": F.col("n_dup_lines") / lines, "repeats": F.col("n_repeat_words") / words,
        "echoes": F.col("n_echoes") / words, "word_length": F.col("word_chars") / words,
    }


def stratum() -> Column:
    """Texts of like length: the number of words by powers of four."""
    return F.least(F.floor(F.log2(F.col("n_words") + 1) / 2), F.lit(STRATA - 1)).cast("int")


def binomial_cdf(k: int, n: int, p: float) -> float:
    """The chance of at most ``k`` successes of ``n``, by the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), 1e-300)
        out = d
        for m in range(1, 10_000):
            for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 + step * d
                c = 1.0 + step / c
                d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
                c = c if abs(c) > 1e-300 else 1e-300
                out *= d * c
            if abs(d * c - 1.0) < 1e-14:
                break
        return out

    a, b, x = n - k, k + 1, 1.0 - p  # P(X <= k) = I_{1-p}(n-k, k+1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    if x < (a + 1) / (a + b + 2):
        return min(1.0, front * fraction(a, b, x) / a)
    return max(0.0, 1.0 - front * fraction(b, a, 1 - x) / b)


def _exceeds(cutoffs: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f"_m.{name}") > cutoffs[name] for name in measures()))


def calibrate(labelled: DataFrame, limit: float = 0.02, alpha: float = 0.05) -> tuple[dict[int, dict[str, float]], list[dict]]:
    """Cutoffs by stratum, and the report of every test.

    ``labelled`` has measured rows with a boolean ``good`` and a ``doc_id``. What comes to the driver is bounded by
    strata x levels x measures, whatever the number of rows.
    """
    rows = labelled.select(stratum().alias("_s"), F.struct(*(c.alias(n) for n, c in measures().items())).alias("_m"), "good", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("_fit"))
    shares = F.array(*(F.lit(1.0 - x) for x in LEVELS))
    proposed = rows.where("_fit and good").groupBy("_s").agg(*(F.percentile_approx(f"_m.{n}", shares, 100_000).alias(n) for n in measures())).collect()
    cutoffs = {(r["_s"], k): {n: float(r[n][k]) + MARGINS[n] for n in measures()} for r in proposed for k in range(len(LEVELS))}
    if not cutoffs:
        return {}, []
    spark = labelled.sparkSession
    shape = "_s int, _level int, _c struct<" + ",".join(f"{n}:double" for n in measures()) + ">"
    table = spark.createDataFrame([(s, k, tuple(c.values())) for (s, k), c in cutoffs.items()], shape)
    tested = (
        rows.where("not _fit").join(F.broadcast(table), "_s").groupBy("_s", "_level")
        .agg(*(F.count_if(cond).alias(n) for n, cond in (
            ("good", F.col("good")), ("bad", ~F.col("good")),
            ("good_out", F.col("good") & _exceeds(F.col("_c"))), ("bad_out", ~F.col("good") & _exceeds(F.col("_c"))))))
        .collect()
    )
    chosen: dict[int, dict[str, float]] = {}
    report = []
    for s in sorted({r["_s"] for r in tested}):
        best, passing = 0.0, True
        for r in sorted((r for r in tested if r["_s"] == s), key=lambda r: r["_level"]):
            chance = binomial_cdf(r["good_out"], r["good"], limit) if r["good"] else 1.0
            passing = passing and chance <= alpha / STRATA
            # Among the levels that pass, any may be taken: bad texts caught, less ten times the share of good ones lost.
            worth = r["bad_out"] / max(1, r["bad"]) - 10 * r["good_out"] / max(1, r["good"])
            if passing and worth > best:
                best, chosen[s] = worth, cutoffs[s, r["_level"]]
            report.append({"stratum": s, "share": LEVELS[r["_level"]], "chance": chance, "passes": passing, **{k: r[k] for k in ("good", "bad", "good_out", "bad_out")}})
    return chosen, report


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdicts(documents: DataFrame, labels: DataFrame, limit: float = 0.02, alpha: float = 0.05) -> DataFrame:
    """Measured ``documents`` with ``base_failed``, ``stratum`` and ``kept``; one row for each input row.

    ``labels`` has ``doc_id`` and ``quality``; null labels are left out, of repeated ids the worse label counts. The
    measures are written to the shared folder and read again, so texts are read once.
    """
    measured = cut(measure(documents))
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    chosen, _ = calibrate(measured.drop("good").join(good, "doc_id"), limit, alpha)
    rejected = F.lit(False)
    for s, cutoffs in chosen.items():
        over = reduce(lambda a, b: a | b, (c > F.lit(cutoffs[n]) for n, c in measures().items()))
        rejected = F.when(stratum() == s, over).otherwise(rejected)
    return measured.withColumns({"base_failed": base_failed(), "stratum": stratum(), "kept": ~base_failed() & ~rejected})
