"""WARC archives: written as one gzip stream a file, then normalised to one gzip member a record with an offset index.

Files go through ``pyarrow.fs`` to the shared folder, so any store that it and Spark both reach will do. A file is
written under a name of its own attempt and then moved to its final name, so a repeated task replaces its own work.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.sums import _store, tune
from millwright.session import new_path

CHUNK = 1 << 20
#: Parts over which the pages of one payload are dealt.
SPREAD = 32
#: Bytes of an archive that are read in one task.
RANGE = 4 << 20
MANIFEST = "path string, records bigint"
INDEX = "path string, offset bigint, length bigint"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # Fixed value: the name space of URLs in RFC 4122.


class _Moved:
    """A file that takes its name when it is whole."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = _store(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.own, compression=None)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.own, self.path)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit keeps the HTTP head, whose length is that of the full payload, and no payload."""
    payload = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        fields.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + '!#$&()*+,/:;=?@[]~' + chr(39))}")
    if page_id is not None:
        fields.append(f"WARC-Page-ID: {page_id}")
    fields.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    block = head + payload
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
        block = head
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *fields, "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record's columns; digest and length of a response are taken from its payload anew."""
    top, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    claimed = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    sizes = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    digest = claimed if revisit else hashlib.sha1(payload).hexdigest()
    if digest != claimed:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": int(sizes["Content-Length"]) if revisit else len(payload),
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To-Page-ID"), "payload": None if revisit else payload,
    }


def records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``page_id, url, html, digest, refers_to``. Of equal payloads of ``least`` bytes or more the largest page_id is the response;
    rows that repeat this id are responses too, and a null id, being no largest, revisits. Without any id all are responses.

    A payload's pages are dealt over ``SPREAD`` parts, so copies of one page, or pages without one, don't meet in one task."""
    digested = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("digest"))
    first = (
        digested.where(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
        .where("copies > 1").select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    )
    dealt = digested.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int"))
    return dealt.join(first, ["digest", "part"], "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"))


def write(rows: DataFrame, folder: str, file_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``records`` to monolithic ``.warc.gz`` files of about ``file_bytes`` before compression; returns their names."""

    def task(batches):
        part, out, zipped, size, count, number = TaskContext.get().partitionId(), None, None, 0, 0, 0
        done = []

        def close():
            zipped.close()
            out.close()
            done.append({"path": out_path, "records": count})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out_path = f"{folder}/whole/part-{part:06d}-{number:05d}.warc.gz"
                    out = _Moved(out_path)
                    zipped, size, count, number = gzip.GzipFile(fileobj=out.out, mode="wb", compresslevel=2, mtime=0), 0, 0, number + 1
                raw = record(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], date)
                zipped.write(raw)
                size, count = size + len(raw), count + 1
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return rows.mapInArrow(task, MANIFEST)


def split(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of a gzip stream, whatever its members; holds one record and one chunk at a time."""
    inflate, held, need = zlib.decompressobj(31), bytearray(), 0
    for chunk in chunks:
        while chunk:
            held += inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            while True:
                if not need and (at := held.find(b"\r\n\r\n")) >= 0:
                    size = next(line for line in bytes(held[:at]).split(b"\r\n") if line.lower().startswith(b"content-length:"))
                    need = at + 4 + int(size.split(b":")[1]) + 4
                if not need or len(held) < need:
                    break
                yield bytes(held[:need])
                del held[:need]
                need = 0
    if held:
        raise ValueError("the stream ends inside a record")


def normalise(manifest: DataFrame) -> DataFrame:
    """Rewrite every file of ``path`` with a gzip member for each record and, beside it, an index of offsets and lengths.

    Each file is inflated once, as a stream, and removed when its copy is whole. Returns the index. Files are dealt over twice
    as many tasks as there are files: without a number, the few rows of the manifest would be merged into one task.
    """
    files = manifest.count()

    def one(path: str) -> list[dict]:
        to = path.replace("/whole/", "/members/")
        store, own = _store(path)
        target = _store(to)
        if store.get_file_info(own).type.name == "NotFound" and target[0].get_file_info(target[1] + ".idx").type.name != "NotFound":
            with target[0].open_input_stream(target[1] + ".idx") as f:  # a repeated task, after its first run had ended
                return [{"path": to, **json.loads(x)} for x in f.read().decode().splitlines()]
        out, at, index = _Moved(to), 0, []
        with store.open_input_stream(own, compression=None) as f:
            for raw in split(iter(lambda: f.read(CHUNK), b"")):
                member = gzip.compress(raw, 2, mtime=0)
                out.out.write(member)
                index.append({"offset": at, "length": len(member)})
                at += len(member)
        out.close()
        side = _Moved(to + ".idx")
        side.out.write("".join(json.dumps(x) + "\n" for x in index).encode())
        side.close()
        store.delete_file(own)
        return [{"path": to, **x} for x in index]

    def task(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist(one(path), pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    return manifest.select("path").repartition(max(1, 2 * files), F.col("path")).mapInArrow(task, INDEX)


def read(index: DataFrame) -> DataFrame:
    """The records that the index names, read by their offsets alone, each ``RANGE`` of an archive in a task."""
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def task(batches):
        name, f = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != name:
                    store, own = _store(path)
                    name, f = path, store.open_input_file(own)
                f.seek(offset)
                rows.append(parse(gzip.decompress(f.read(length))))
                if sum(len(r["payload"] or b"") for r in rows[-64:]) > CHUNK or len(rows) >= 256:
                    yield pa.RecordBatch.from_pylist(rows, types)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, types)

    ranges = index.select("path", "offset", "length").repartition(1 + 2 * total // RANGE, F.col("path"), F.floor(F.col("offset") / RANGE))
    return ranges.sortWithinPartitions("path", "offset").mapInArrow(task, RECORD)


def archive(pages: DataFrame, folder: str | None = None, least: int = 1000, file_bytes: int = 64 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives, normalise them and return their records as read back.

    Null html is an empty payload; null urls and ids leave their field out. Repeated rows are records of their own.
    """
    spark = tune(pages.sparkSession, 256)
    folder = folder or new_path(spark, "warc")
    write(records(pages, least), folder, file_bytes).write.parquet(f"{folder}/manifest")
    normalise(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")).write.parquet(f"{folder}/index")
    return read(spark.read.schema(INDEX).parquet(f"{folder}/index"))
