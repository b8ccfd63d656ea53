import gzip
import hashlib
import io

import pytest

from millwright.llm import warc

LONG, OTHER = "é" * 600, "y" * 1500
PAGES = [(1, "http://a/1", LONG), (5, "http://a/ü x\r\n", LONG), (3, None, LONG), (2, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", OTHER), (9, "u", LONG[:-1]), (8, "v", OTHER), (None, "w", LONG)]


def test_archive_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive(pages, file_bytes=2000).collect()), key=str)
    expected = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        largest = max(p for p, _, h in PAGES if h == html and p is not None)
        revisit = len(raw) >= 1000 and page_id != largest
        expected.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    assert got == sorted(expected, key=str)


def test_files(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").coalesce(1)
    warc.archive(pages, tmp_path.as_uri())
    assert not list((tmp_path / "whole").glob("*.gz"))
    for f in (tmp_path / "members").glob("*.gz"):
        raw = f.read_bytes()
        members = [x for x in warc.split(iter([raw]))]
        index = f.with_name(f.name + ".idx").read_text().splitlines()
        assert len(index) == len(members) == 11
        assert b"".join(members) == gzip.decompress(raw)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_split_of_one_stream_and_of_members(chunk):
    raw = [warc.record(i, "u", "x" * i * 37, hashlib.sha1(("x" * i * 37).encode()).hexdigest(), None, "d") for i in range(8)]
    for packed in (gzip.compress(b"".join(raw)), b"".join(map(gzip.compress, raw))):
        stream = io.BytesIO(packed)
        assert list(warc.split(iter(lambda: stream.read(chunk), b""))) == raw
    with pytest.raises(ValueError):
        list(warc.split(iter([gzip.compress(raw[3][:-3])])))


def test_a_damaged_payload_is_found():
    raw = warc.record(1, "u", "hello", hashlib.sha1(b"hello").hexdigest(), None, "d")
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"hello", b"hellp"))


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_files_are_normalised_and_read_in_many_tasks(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " * 700) for i in range(60)], "page_id bigint, url string, html string").repartition(20)
    warc.write(warc.records(pages), tmp_path.as_uri(), 2000).write.parquet(f"{tmp_path.as_uri()}/manifest")
    manifest = spark.read.parquet(f"{tmp_path.as_uri()}/manifest")
    files = manifest.count()
    index = warc.normalise(manifest)
    index.write.parquet(f"{tmp_path.as_uri()}/index")
    tasks = len([f for f in (tmp_path / "index").iterdir() if f.name.startswith("part-")])
    assert files >= 20 and tasks >= files // 3 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    found = warc.read(spark.read.schema(warc.INDEX).parquet(f"{tmp_path.as_uri()}/index"))
    assert sorted(r.page_id for r in found.collect()) == list(range(60))


def test_copies_of_one_page_are_dealt_over_parts(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('u', id) AS url", f"'{LONG}' AS html")
    rows = warc.records(pages)
    assert rows.where("refers_to = 2999").count() == 2999
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan
