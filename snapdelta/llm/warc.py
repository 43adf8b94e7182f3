"""WARC archives: a writer with revisit records and a splittable reader.

Each task writes one gzip file, a member per record. Of records with equal payloads
the one with the smallest page id is the response; the others are revisits that
refer to it and carry headers only. Equality is that of SHA-1 digest and length.

The reader cuts files into byte ranges. A task looks for gzip magic in its range,
takes a candidate for a member only if it inflates to the head of a WARC record, and
owns the records that start inside its range, reading past its end to finish the
last one. From an accepted record on, members follow each other, so only the first
record of a range is searched for. Files of any size are read by many tasks.

A null payload is empty. A null page id is kept as such; it is never the smallest
where another row has one. Repeated rows with the smallest id are all responses.
Archives go to the shared folder through Arrow's file systems; a list of finished
files, kept by Spark, hides those of failed task attempts from readers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from .common import Stages

MAGIC = b"\x1f\x8b\x08"
SPLIT = 8 << 20
BLOCK = 1 << 18
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = re.compile(rb"WARC/1\.\d\r\n((?:[^\r\n]+\r\n)+)\r\n")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose HTTP headers still tell the payload's length."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~%"))
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if revisit:
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_response(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, refers_to``: the response's id for revisits, else null."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.unhex(F.sha1("html")), "n": F.octet_length("html")})
    groups = rows.groupBy("digest", "n").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    groups = groups.filter("copies > 1").select("digest", "n", "first", salts)
    # Copies of one payload are spread over salts, so that a payload of many rows is many tasks' work.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(groups, ["digest", "n", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Write one archive per task below the shared folder; returns ``path, length, records``."""
    spark = pages.sparkSession
    base = new_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(base)
        fs.create_dir(folder, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        length = records = 0
        out = None
        for b in batches:
            for row in b.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                data = member(record(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], date))
                out.write(data)
                length += len(data)
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{base}/{name}"], "length": [length], "records": [records]})

    done = with_response(pages).mapInArrow(write, "path STRING, length BIGINT, records BIGINT")
    return Stages(spark).write(done, "warc-files", keep=True)


@dataclass(frozen=True)
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


class _Window:
    """Sequential bytes of a file from some offset on, fetched in blocks."""

    def __init__(self, source, size: int, at: int):
        self.source, self.size = source, size
        self.at, self.data = at, bytearray()

    def more(self) -> bool:
        end = self.at + len(self.data)
        if end >= self.size:
            return False
        self.source.seek(end)
        got = self.source.read(min(BLOCK, self.size - end))
        self.data += got
        return bool(got)

    def drop(self, to: int) -> None:
        del self.data[: to - self.at]
        self.at = to


def _member(window: _Window) -> tuple[bytes, int] | None:
    """The member at the window's start and the offset behind it; None if there is no
    WARC record there. Only the head is inflated until it proves to be one."""
    z = zlib.decompressobj(31)
    out, used, checked = [], 0, False
    try:
        while not z.eof:
            if used >= len(window.data) and not window.more():
                return None
            chunk = window.data[used : used + BLOCK]
            used += len(chunk)
            out.append(z.decompress(chunk))
            if not checked:
                head = b"".join(out)
                if head[:7] != b"WARC/1."[: len(head)]:
                    return None
                checked = len(head) >= 7
    except zlib.error:
        return None
    return b"".join(out), window.at + used - len(z.unused_data)


def parse(data: bytes, offset: int) -> Record | None:
    head = HEAD.match(data)
    if head is None:
        return None
    lines = head[1].decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, s, v in (x.partition(":") for x in lines) if s}
    if not headers.get("content-length", "").isdigit():
        return None
    block = data[head.end() : head.end() + int(headers["content-length"])]
    return Record(offset, headers, block) if len(block) == int(headers["content-length"]) else None


def records_in(source, size: int, start: int, end: int) -> Iterator[Record]:
    """Records whose members start in ``[start, end)``."""
    window = _Window(source, size, start)
    while window.at < end:
        at = window.data.find(MAGIC)
        if at < 0:
            keep = max(window.at, window.at + len(window.data) - 2)
            if keep >= end or not window.more():
                return
            window.drop(max(keep, window.at))
            continue
        if window.at + at >= end:
            return
        window.drop(window.at + at)
        found = _member(window)
        got = parse(found[0], window.at) if found else None
        if got is None:
            window.drop(window.at + 1)
            continue
        yield got
        window.drop(found[1])


def lost_records(files: DataFrame, records: DataFrame) -> DataFrame:
    """``path, records, found`` of the archives of ``write_archives`` in which a reader found fewer (or more)
    records than were written: damaged members are passed over by :func:`read_archives`, and told here."""
    found = records.groupBy("path").agg(F.count("*").alias("found"))
    both = files.select("path", "records").join(found, "path", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.filter("records <> found")


COLUMNS = "path STRING, offset BIGINT, record_type STRING, record_id STRING, refers_to STRING, url STRING, payload_digest STRING, payload_bytes BIGINT, payload BINARY"


def read_archives(spark: SparkSession, files: DataFrame, split: int = SPLIT, payload: bool = True) -> DataFrame:
    """All records of ``files`` (``path, length``): types, ids, digests and payloads. A
    revisit has the digest and length of the full payload, but no payload."""
    size = files.agg(F.sum(F.ceil(F.col("length") / split))).first()[0] or 0
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split).cast("bigint")))
    ranges = files.select("path", "length", starts.alias("start")).repartition(max(1, int(size)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                fs, path = pafs.FileSystem.from_uri(r["path"])
                rows = []
                with fs.open_input_file(path) as f:
                    for x in records_in(f, r["length"], r["start"], min(r["length"], r["start"] + split)):
                        rows.append(_row(r["path"], x, payload))
                        if len(rows) >= 512:
                            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return ranges.mapInArrow(read, COLUMNS)


ARROW = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("refers_to", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])


def _row(path: str, x: Record, payload: bool) -> dict:
    kind = x.headers.get("warc-type")
    row = {"path": path, "offset": x.offset, "record_type": kind, "record_id": x.headers.get("warc-record-id")}
    row |= {"refers_to": x.headers.get("warc-refers-to"), "payload": None}
    url = x.headers.get("warc-target-uri")
    row["url"] = None if url is None else unquote(url)
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)", x.block)
        row["payload_digest"] = x.headers.get("warc-payload-digest", "").removeprefix("sha1:")
        row["payload_bytes"] = int(length[1]) if length else None
    else:
        row["payload_digest"], row["payload_bytes"] = digest(x.payload), len(x.payload)
        row["payload"] = x.payload if payload else None
    return row


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of archived pages."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) AS BIGINT)")
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
