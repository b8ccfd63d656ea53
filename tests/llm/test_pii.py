import hashlib
import re

from pyspark.sql import functions as F

from millwright.llm import pii


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


# The patterns of the contract, searched by another engine.
PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def brute(text):
    found = [(m.start(), k, m.end(), name) for k, (name, (p, ok)) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if ok(m[0])]
    return sorted(found)


TEXTS = [
    None, "", "no data", "a@b.c_x@d.e 1.2.3.4.5.6.7.8", "call +1 (234) 555-1234 or +12 34", "4111 1111 1111 1111, 4111-1111-1111-1112",
    "256.1.1.1 00.01.002.255 1.2.3", "é漢😀 a.b@c.d.e. 😀1.2.3.4", "a@" * 500 + "b.c", "1" * 3000, "1." * 900, "x@y" + ".z" * 3000,
    "+1 2 3 4 5 6 7 8 9 0 +123456789 ++12 345 6789", "same a@b.cd a@b.cd a@b.cd", "same a@b.cd a@b.cd a@b.cd",
]


def test_base_spans_equal_another_engine(docs):
    frame = docs(TEXTS)
    for r in pii.digest(pii.find(frame)).collect():
        expected = brute(TEXTS[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in expected)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[3] == k for x in expected) for k in PATTERNS]
        assert set(written.split(",")) - {""} <= set(r.spans.split(","))


def test_credentials_are_learnt_without_labels(docs):
    secrets = [f"{i:02d}c8b45435718dcc700c184a7e303cdc64c6a8f7f" for i in range(12)]
    texts = [f'text {i}. 3. password={s[:18]} or "{s}" more' for i, s in enumerate(secrets)] + [f"version {i}.0 of page {i} 12:30 4, {i}" for i in range(40)]
    found = pii.find(docs(texts)).select("doc_id", F.expr("transform(filter(spans, s -> s.kind = 'secret'), s -> s.text)").alias("s")).collect()
    for r in found:
        expected = [secrets[r.doc_id][:18], secrets[r.doc_id]] if r.doc_id < 12 else []
        assert r.s == expected


def test_masking(docs):
    frame = docs(["mail a@b.cd now 1.2.3.4", None, "", "clean"])
    got = [r.m for r in pii.find(frame).withColumn("m", pii.masked("text")).orderBy("doc_id").collect()]
    assert got == ["mail <email> now <ip>", None, "", "clean"]


def test_reliable_labelers_outweigh_a_poor_one():
    counts = {(1, 1, 0): 80, (0, 0, 0): 100, (1, 1, 1): 70, (0, 0, 1): 90, (1, -1, 1): 5, (0, -1, 0): 5}
    posterior, chances = pii.expectation_maximisation(counts)
    assert posterior[1, 1, 0] > 0.9 and posterior[0, 0, 1] < 0.1
    assert chances[0][1][2] > 0.9 and abs(chances[2][1][2] - chances[2][0][2]) < 0.2


def test_empty_table(docs):
    assert pii.digest(pii.find(docs([]))).collect() == []


def test_masking_by_places(docs):
    import random

    rng = random.Random(2)
    parts = ["é漢😀 words ", "a@b.cd ", "1.2.3.4 ", "+123456789 ", "x" * 5000 + " ", "4111 1111 1111 1111 ", "v12 "]
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 5, 400]))) for _ in range(12)]
    for r in pii.find(docs(texts)).withColumn("m", pii.masked("text")).collect():
        out, at, text = [], 0, texts[r.doc_id]
        for s in r.spans:
            if s.start >= at:
                out += [text[at : s.start], f"<{s.kind}>"]
                at = s.end
        assert r.m == "".join([*out, text[at:]])


def test_credentials_beside_base_spans(spark):
    shape = "array<struct<start:int,kind_order:int,end:int,kind:string,text:string>>"
    rows = [([(5, 4, 9, "secret", "a"), (20, 4, 30, "secret", "b"), (40, 4, 41, "secret", "c")], [(9, 0, 12, "email", ""), (25, 1, 26, "ip", ""), (41, 1, 44, "ip", "")]),
            ([(5, 4, 9, "secret", "a")], [(0, 0, 6, "email", "")]), ([(5, 4, 9, "secret", "a")], [(0, 0, 50, "email", ""), (1, 2, 3, "card", "")]), ([(5, 4, 9, "secret", "a")], []), ([], [(0, 0, 6, "email", "")])]
    got = spark.createDataFrame(rows, f"s {shape}, t {shape}").select(pii._free("s", "t").alias("f")).collect()
    assert [[x.text for x in r.f] for r in got] == [["a", "c"], [], [], ["a"], []]


def test_work_is_in_proportion_to_a_text(docs):
    import time

    def seconds(count):
        frame = docs(["v123 aaa a@b.cd " * count])
        began = time.time()
        (row,) = pii.find(frame, model).withColumn("m", pii.masked("text")).select(F.size("base_spans").alias("n"), F.size("spans").alias("s"), F.size(F.split("m", "<")).alias("l")).collect()
        assert row.n == count and row.l == row.s + 1
        return time.time() - began

    model = pii.train(docs(["password=a8f7s9d8f7a9s8df7 page 3", "page 4"]))
    seconds(10)
    few = seconds(20_000)
    assert seconds(160_000) < 16 * max(few, 1)  # 2.4 MB
