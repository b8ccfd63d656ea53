"""Personal data: fixed patterns, and credentials found by weak supervision. Columns and SQL functions only.

Emails, addresses, cards and phones follow patterns. Credentials have none; labelers vote on every run of characters that
holds a digit: patterns, a gazetteer of names that credentials go by, and the words and signs around it. Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is in either class, whatever the corpus size from at most
``3 ** len(labelers)`` rows. The votes' posteriors then train the final classifier (naive Bayes over the
look of the run alone), which decides the spans, also of runs on which every labeler abstains.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.session import cut

KINDS = ("email", "ip", "card", "phone", "secret")
#: Possessive forms of the patterns: they match the same and never back up over a run of characters.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
RUN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_SPAN = "struct<start:int,end:int,text:string,before:string>"
#: Items of an array that are gone through together, and characters of a text that are kept together.
BLOCK, CHARACTERS = 128, 4096

# Names that credentials go by, and words beside which numbers are harmless.
NAMES = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "credential", "bearer", "private_key", "auth")
HARMLESS = ("version", "section", "chapter", "page", "clause", "copyright", "license", "no.", "vol.", "fig.")


def _found(text: Column, pattern: str, wanted: Column) -> Column:
    return F.when(wanted, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda uses it again and again."""
    return F.transform(F.array(value), body)[0]


def _scan(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step`` emits over ``items`` in order: it takes state and item and gives the new state and an array of ``kind``.

    An array that grows by one element at a time is copied each time. So a first pass finds the state before every block of
    ``BLOCK`` items, and a second one goes through each block from there; the work is in proportion to the items.
    """

    def emitted(part: Column, before: Column) -> Column:
        first = F.struct(before.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))

        def one(held: Column, item: Column) -> Column:
            after, out = step(held["state"], item)
            return F.struct(after.alias("state"), F.concat(held["out"], out).alias("out"))

        return F.aggregate(part, first, one, lambda held: held["out"])

    def passed(held: Column, part: Column) -> Column:
        after = F.aggregate(part, F.element_at(held, -1), lambda at, item: step(at, item)[0])
        return F.concat(held, F.array(after))

    def through(blocks: Column) -> Column:
        before = F.aggregate(F.slice(blocks, 1, F.size(blocks) - 1), F.array(state), passed)
        return F.flatten(F.zip_with(blocks, before, emitted))

    def cut_up(whole: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda k: F.slice(whole, k * BLOCK + 1, BLOCK))

    scanned = _let(items, lambda whole: F.when(F.size(whole) > 0, _let(cut_up(whole), through)))
    return F.coalesce(scanned, F.array().cast(f"array<{kind}>"))


def _placed(text: Column, pattern: str, found: Column) -> Column:
    """The matches with their places in characters, from the lengths of what stands between them."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        span = F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("text"), x["before"].alias("before"))
        return start + F.coalesce(F.length(x["m"]), F.lit(0)), F.when(x["m"].isNull(), F.array().cast(f"array<{_SPAN}>")).otherwise(F.array(span))

    pairs = F.zip_with(F.split(text, pattern, -1), found, lambda b, m: F.struct(F.length(b).alias("gap"), F.right(b, F.lit(24)).alias("before"), m.alias("m")))
    return F.when(F.size(found) > 0, _scan(pairs, F.lit(0), step, _SPAN)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _is_card(s: Column) -> Column:
    d = _digits(s["text"])
    return F.length(d).between(12, 19) & F.call_function("luhn_check", d)


#: By kind: the pattern, what a text must hold to be searched, and the test that a match must pass.
BASE = {
    "email": (EMAIL, lambda t, digit: t.contains("@"), None),
    "ip": (IP, lambda t, digit: digit, lambda s: s["text"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (CARD, lambda t, digit: digit, _is_card),
    "phone": (PHONE, lambda t, digit: digit & t.contains("+"), lambda s: F.length(_digits(s["text"])).between(9, 15)),
}


def _core(s: Column) -> Column:
    """The run without what stands before ``=`` or ``:``, quotes and closing signs."""
    return F.regexp_replace(F.regexp_replace(s["text"], r"""^[A-Za-z_.-]+[=:]+""", ""), r"""^["'(\[<]+|[^A-Za-z0-9]+$""", "")


def labelers(s: Column) -> dict[str, Column]:
    """Votes on a run: 1 credential, 0 harmless, -1 no opinion."""
    core, text = _core(s), s["text"]
    names = "|".join(n.replace(".", r"\.") for n in NAMES)
    vote = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    never = F.lit(False)
    return {
        "hex pattern": vote(core.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$") | core.rlike("^(?=.*[0-9])(?=.*[A-F])[0-9A-F]{16,}$"), never),
        "key pattern": vote(core.rlike("^[A-Z]{4}(?=[A-Z0-9]*[0-9])[A-Z0-9]{12,}$") | core.rlike("^[A-Za-z]{2,6}[_-][A-Za-z0-9_-]*[0-9][A-Za-z0-9_-]{14,}$"), never),
        "number pattern": vote(never, core.rlike("^[0-9.,:()+%/-]*$")),
        "name": vote(F.lower(text).rlike(rf"^[^a-z]*(?:[a-z_.-]*)(?:{names})[a-z_]*[=:]"), never),
        "words before": vote(F.lower(s["before"]).rlike(rf"(?:{names})[\s:=is]*$"), F.lower(s["before"]).rlike(rf"(?:{'|'.join(h.replace('.', chr(92) + '.') for h in HARMLESS)})\s*$")),
        "quotes": vote(text.rlike("""^["'][A-Za-z0-9+/_=-]{16,}["'][.,;]?$"""), never),
        "length": vote(never, F.length(core) < 8),
    }


def features(s: Column) -> dict[str, tuple[Column, int]]:
    """The look of a run: a class for each feature, and how many classes there are."""
    core = _core(s)
    changes = F.length(F.regexp_replace(F.regexp_replace(core, "[0-9]+", "9"), "[A-Za-z]+", "a"))
    plain = F.length(F.regexp_replace(core, "[^A-Za-z0-9]", ""))
    return {
        "length": (F.least(F.floor(F.length(core) / 4), F.lit(8)).cast("int"), 9),
        "letters": (F.when(core.rlike("[a-z]"), 1).otherwise(0) + F.when(core.rlike("[A-Z]"), 2).otherwise(0), 4),
        "changes": (F.least(changes, F.lit(9)).cast("int"), 10),
        "signs": (F.least(F.length(core) - plain, F.lit(4)).cast("int"), 5),
    }


def _code(parts: list[tuple[Column, int]]) -> Column:
    code = F.lit(0)
    for value, size in parts:
        code = code * size + value
    return code


def _votes_code(s: Column) -> Column:
    return _code([(v + 1, 3) for v in labelers(s).values()])


def expectation_maximisation(counts: dict[tuple[int, ...], int], rounds: int = 100, smooth: float = 0.5) -> tuple[dict[tuple[int, ...], float], list[list[list[float]]]]:
    """Posterior of each vote pattern, and each labeler's chances of the votes -1, 0, 1 in either class. Starts from the majority."""
    width = len(next(iter(counts), ()))
    posterior = {v: min(0.9, max(0.1, 0.5 + 0.4 * (v.count(1) - v.count(0)) - 0.1 * (1 not in v))) for v in counts}
    chances: list[list[list[float]]] = []
    for _ in range(rounds):
        mass = [smooth + sum(n * (posterior[v] if c else 1 - posterior[v]) for v, n in counts.items()) for c in (0, 1)]
        chances = []
        for k in range(width):
            seen = [[smooth] * 3, [smooth] * 3]
            for v, n in counts.items():
                seen[1][v[k] + 1] += n * posterior[v]
                seen[0][v[k] + 1] += n * (1 - posterior[v])
            chances.append([[x / sum(row) for x in row] for row in seen])
        after = {}
        for v in counts:
            odds = math.log(mass[1] / mass[0]) + sum(math.log(chances[k][1][x + 1] / chances[k][0][x + 1]) for k, x in enumerate(v))
            after[v] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        moved = max((abs(after[v] - posterior[v]) for v in counts), default=0.0)
        posterior = after
        if moved < 1e-9:
            break
    return posterior, chances


def train(documents: DataFrame, text: str = "text") -> tuple[float, dict[str, list[float]]]:
    """The classifier: its bias, and the log odds of each class of each feature. Learns from every run of every text."""
    content = F.coalesce(F.col(text), F.lit(""))
    runs = documents.select(content.alias("t")).where(F.col("t").rlike("[0-9]")).select("t", F.regexp_extract_all("t", F.lit(RUN), F.lit(0)).alias("m")).where(F.size("m") > 0)
    pairs = F.zip_with(F.split("t", RUN, -1), "m", lambda b, m: F.struct(m.alias("text"), F.right(b, F.lit(24)).alias("before")))
    run = runs.select(F.explode(pairs).alias("s")).where(F.col("s.text").isNotNull())
    looks = features(F.col("s"))
    seen = cut(run.select(_votes_code(F.col("s")).alias("votes"), _code(list(looks.values())).alias("look")).groupBy("votes", "look").agg(F.count("*").alias("n")))
    width = len(labelers(F.col("s")))
    patterns = {tuple(r["votes"] // 3 ** (width - 1 - k) % 3 - 1 for k in range(width)): r["n"] for r in seen.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    posterior, _ = expectation_maximisation(patterns)
    if not posterior:
        return -math.inf, {n: [0.0] * size for n, (_, size) in looks.items()}
    by_code = {sum((x + 1) * 3 ** (width - 1 - k) for k, x in enumerate(v)): p for v, p in posterior.items()}
    chance = F.element_at(F.create_map(*(F.lit(x) for item in sorted(by_code.items()) for x in item)), F.col("votes"))
    mass = seen.groupBy("look").agg(F.sum(F.col("n") * chance).alias("yes"), F.sum(F.col("n") * (1 - chance)).alias("no")).collect()
    yes, no = 0.5 + sum(r["yes"] for r in mass), 0.5 + sum(r["no"] for r in mass)
    weights: dict[str, list[float]] = {}
    below = 1
    for name, (_, size) in reversed(looks.items()):
        sums = [[0.5, 0.5] for _ in range(size)]
        for r in mass:
            at = r["look"] // below % size
            sums[at][1] += r["yes"]
            sums[at][0] += r["no"]
        weights[name] = [math.log(s[1] / (yes + size / 2)) - math.log(s[0] / (no + size / 2)) for s in sums]
        below *= size
    return math.log(yes / no), weights


def _is_secret(model: tuple[float, dict[str, list[float]]]):
    bias, weights = model

    def test(s: Column) -> Column:
        if math.isinf(bias):
            return F.lit(False)
        odds = F.lit(bias)
        for name, (value, _) in features(s).items():
            odds = odds + F.element_at(F.array(*(F.lit(w) for w in weights[name])), value + 1)
        return odds > 0

    return test


def _trimmed(s: Column) -> Column:
    """The credential itself, without its name, quotes and closing signs."""
    core = _core(s)
    start = s["start"] + F.position(core, s["text"]) - 1
    return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("text"), s["before"].alias("before"))


def find(documents: DataFrame, model: tuple[float, dict[str, list[float]]] | None = None, text: str = "text") -> DataFrame:
    """``documents`` with ``base_spans`` and ``spans``: arrays of (start, kind_order, end, kind, text), places in characters, end exclusive,
    by start and then kind as in ``KINDS``. A credential that overlaps a base span is left out.

    Null texts count as empty and have no spans; columns of the new names are replaced. Works row by row without a shuffle.
    """
    model = model or train(documents, text)
    kept = [c for c in documents.columns if c not in ("base_spans", "spans")]
    content = F.coalesce(F.col(text), F.lit(""))
    digit = content.rlike("[0-9]")
    searched = {k: (p, need(content, F.col("_digit"))) for k, (p, need, _) in BASE.items()} | {"secret": (RUN, F.col("_digit"))}
    rows = documents.select(*kept, digit.alias("_digit"))
    rows = rows.select("*", *(_found(content, p, need).alias(f"_m_{k}") for k, (p, need) in searched.items()))
    rows = rows.select("*", *(_placed(content, p, F.col(f"_m_{k}")).alias(f"_p_{k}") for k, (p, _) in searched.items()))

    def named(kind: str, spans: Column) -> Column:
        order = KINDS.index(kind)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind_order"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["text"].alias("text")))

    base = [named(k, F.filter(f"_p_{k}", test) if test else F.col(f"_p_{k}")) for k, (_, _, test) in BASE.items()]
    rows = rows.select("*", F.sort_array(F.concat(*base)).alias("base_spans"))
    secret = F.transform(F.filter("_p_secret", _is_secret(model)), _trimmed)
    rows = rows.select(*kept, "base_spans", F.sort_array(named("secret", secret)).alias("_secret"))
    return rows.select(*kept, "base_spans", F.sort_array(F.concat("base_spans", _free("_secret", "base_spans"))).alias("spans"))


def _free(spans: str, taken: str) -> Column:
    """Those of ``spans`` that overlap none of ``taken``: one pass forwards finds what reaches into a span, one backwards what starts in it."""
    kind = "struct<start:int,kind_order:int,end:int,kind:string,text:string>"
    nothing = F.array().cast(f"array<{kind}>")
    is_taken = lambda s: s["kind_order"] < KINDS.index("secret")

    def forwards(reach: Column, s: Column) -> tuple[Column, Column]:
        kept = is_taken(s) | (s["start"] >= reach)
        return F.when(is_taken(s), F.greatest(reach, s["end"])).otherwise(reach), F.when(kept, F.array(s)).otherwise(nothing)

    def backwards(least: Column, s: Column) -> tuple[Column, Column]:
        kept = ~is_taken(s) & (s["end"] <= least)
        return F.when(is_taken(s), F.least(least, s["start"])).otherwise(least), F.when(kept, F.array(s)).otherwise(nothing)

    ahead = _scan(F.sort_array(F.concat(taken, spans)), F.lit(-1), forwards, kind)
    free = F.reverse(_scan(F.reverse(ahead), F.lit(2**31 - 1), backwards, kind))
    return F.when((F.size(spans) > 0) & (F.size(taken) > 0), free).otherwise(F.col(spans))


def written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(written("base_spans"), 256).alias("base_sha256"), written("spans").alias("spans"))


def masked(text: str, spans: str = "spans") -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts."""

    def between(blocks: Column, low: Column, high: Column) -> Column:
        """Characters from ``low`` to before ``high``: a piece of a block, or the ends of two and the blocks between them."""
        first, last = F.floor(low / CHARACTERS).cast("int"), F.floor((high - 1) / CHARACTERS).cast("int")
        head, tail = F.pmod(low, F.lit(CHARACTERS)) + 1, F.pmod(high - 1, F.lit(CHARACTERS)) + 1
        several = F.concat(F.substring(blocks[first], head, F.lit(CHARACTERS)), F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), F.substring(blocks[last], F.lit(1), tail))
        return F.when(high <= low, "").when(first == last, F.substring(blocks[first], head, high - low)).otherwise(several)

    def rewritten(blocks: Column) -> Column:
        end = F.struct(F.length(text).alias("start"), F.lit(len(KINDS)).alias("kind_order"), F.length(text).alias("end"), F.lit(None).cast("string").alias("kind"), F.lit("").alias("text"))

        def step(at: Column, s: Column) -> tuple[Column, Column]:
            name = F.when(s["kind"].isNull(), "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
            pieces = F.array(between(blocks, at, s["start"]), name)
            return F.when(s["start"] < at, at).otherwise(s["end"]), F.when(s["start"] < at, F.array().cast("array<string>")).otherwise(pieces)

        return F.array_join(_scan(F.concat(F.col(spans), F.array(end)), F.lit(0), step, "string"), "")

    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{CHARACTERS}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(blocks, rewritten)).otherwise(F.col(text))
