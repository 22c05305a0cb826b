"""Archives of WARC records in ZIP files, written and read by Spark.

An archive is a ZIP file of two stored members: ``archive/data.warc.gz``, whose records are
compressed one by one, and ``indexes/index.cdxj``, with a line per record that says where it lies.
Sizes and offsets are written in ZIP64 form wherever the classic form can't hold them, or always
if asked. Reading starts at the end of the file: end record, ZIP64 locator and record, central
directory, local headers; then the index is read, and each record by its range of bytes. Nothing
is unpacked to disk.

Rows of an archive share a task; how many an archive holds follows from ``ARCHIVE_BYTES``. Writing
goes through Spark's committer, so a lost task leaves nothing behind and is run again.

A null html is an empty payload. Records with equal payloads: the one with the smallest id is a
response, the others revisit it; rows that repeat that id as well are responses too. A null id is
written as such; it is a response only if all records of its payload lack an id. Payloads smaller
than ``least_bytes`` are always responses. An empty table makes no archive and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_path
from .common import small_side, written

# Payload bytes after which a task begins a new archive; a record more may go over it.
ARCHIVE_BYTES = 16 << 20

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Fixed values of the ZIP format: signatures, and the mark of a field moved to ZIP64.
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
# Lower limit of dates in the format: 1 January 1980, midnight.
_DATE = 0x21


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def zip_file(members: list[tuple[str, list[bytes]]], zip64: bool = False, comment: bytes = b"") -> bytes:
    """A ZIP file of stored members, each given in pieces."""
    out, entries = [], []
    at = 0
    for name, parts in members:
        size = sum(map(len, parts))
        crc = 0
        for part in parts:
            crc = zlib.crc32(part, crc)
        wide = zip64 or size >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        short = FULL32 if wide else size
        title = name.encode()
        head = struct.pack("<IHHHHHIIIHH", LOCAL, 45 if wide else 20, 0x800, 0, 0, _DATE, crc, short, short, len(title), len(extra))
        out += [head, title, extra, *parts]
        entries.append((title, crc, size, at))
        at += len(head) + len(title) + len(extra) + size
    start = at
    for title, crc, size, offset in entries:
        wide = zip64 or max(size, offset) >= FULL32
        extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if wide else b""
        short, place = (FULL32, FULL32) if wide else (size, offset)
        row = struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if wide else 20, 0x800, 0, 0, _DATE, crc, short, short,
                          len(title), len(extra), 0, 0, 0, 0, place)
        out += [row, title, extra]
        at += len(row) + len(title) + len(extra)
    n, length = len(entries), at - start
    wide = zip64 or n >= FULL16 or max(length, start) >= FULL32
    if wide:
        out.append(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, length, start))
        out.append(struct.pack("<IIQI", LOCATOR64, 0, at, 1))
    few, short, place = (FULL16, FULL32, FULL32) if wide else (n, length, start)
    out.append(struct.pack("<IHHHHIIH", END, 0, 0, few, few, short, place, len(comment)) + comment)
    return b"".join(out)


class Member(NamedTuple):
    """A member of a ZIP file: where its bytes begin, how many, and whether they are stored as they are."""

    start: int
    size: int
    stored: bool


def directory(read, length: int) -> dict[str, Member]:
    """Members of a ZIP file by name; ``read(start, size)`` gives a range of its bytes."""
    tail_at = max(0, length - 22 - FULL16)
    tail = read(tail_at, length - tail_at)
    place = len(tail)
    while True:  # the end record is the last one whose comment reaches just to the end
        place = tail.rfind(struct.pack("<I", END), 0, place)
        if place < 0:
            raise ValueError("no end of central directory")
        if place + 22 <= len(tail) and place + 22 + struct.unpack_from("<H", tail, place + 20)[0] == len(tail):
            break
    n, size, start = struct.unpack_from("<HII", tail, place + 10)
    if n == FULL16 or FULL32 in (size, start):
        locator = read(tail_at + place - 20, 20)
        signature, _, at, _ = struct.unpack("<IIQI", locator)
        if signature != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = read(at, 56)
        if struct.unpack_from("<I", record)[0] != END64:
            raise ValueError("no ZIP64 end of central directory")
        n, size, start = struct.unpack_from("<QQQ", record, 32)
    rows, at, found = read(start, size), 0, {}
    for _ in range(n):
        if struct.unpack_from("<I", rows, at)[0] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", rows, at + 10)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", rows, at + 20)
        offset, = struct.unpack_from("<I", rows, at + 42)
        name = rows[at + 46 : at + 46 + n_name].decode()
        extra, k = rows[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, many = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # holds those of the fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{many // 8}Q", extra, k + 4))
                full = next(wide) if full == FULL32 else full
                packed = next(wide) if packed == FULL32 else packed
                offset = next(wide) if offset == FULL32 else offset
            k += 4 + many
        head = read(offset, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ValueError("broken local header")
        skip = sum(struct.unpack_from("<HH", head, 26))
        found[name] = Member(offset + 30 + skip, packed, method == 0)
        at += 46 + n_name + n_extra + n_comment
    return found


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, compressed. A revisit has the HTTP headers, with their length, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_text(page)}>",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        headers += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    f"WARC-Refers-To: <urn:page:{_text(refers_to)}>"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _text(page: int | None) -> str:
    return "" if page is None else str(page)


def parse_record(data: bytes) -> dict:
    """Headers, HTTP length and payload of one compressed record."""
    plain = zlib.decompress(data, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"headers": headers, "length": length, "payload": payload}


def _page_of(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def first_of_payload(pages: DataFrame, least_bytes: int, page_id: str, html: str) -> DataFrame:
    """The smallest id of each digest that more than one record has."""
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    digests = pages.select(F.sha(body).alias("d"), F.octet_length(body).alias("n"), F.col(page_id).alias("p"))
    found = digests.filter(F.col("n") >= least_bytes).groupBy("d").agg(F.min("p").alias("first"), F.count("*").alias("many"))
    return written(found.filter("many > 1").select("d", "first"), "payloads")


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False,
) -> None:
    """Write a record for each page into archives under ``path``."""
    body = F.coalesce(F.col(f"p.{html}").cast("binary"), F.lit(b""))
    firsts = small_side(first_of_payload(pages, least_bytes, page_id, html))
    rows = pages.alias("p").join(firsts.alias("f"), F.sha(body) == F.col("f.d"), "left").select(
        F.col(f"p.{page_id}").alias("page"), F.col(f"p.{url}").alias("url"), body.alias("body"), F.col("f.first"),
        (F.col("f.d").isNotNull() & ~F.col(f"p.{page_id}").eqNullSafe(F.col("f.first")) & (F.octet_length(body) >= least_bytes)).alias("revisit"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, index, at, size = [], [], 0, 0
        for batch in batches:
            for page, link, body, first, revisit in zip(*(c for c in batch.columns)):
                payload = body.as_buffer().to_pybytes()
                digest = payload_digest(payload)
                page, again = page.as_py(), revisit.as_py()
                data = record(page, link.as_py(), payload, digest, first.as_py(), again)
                index.append(json.dumps({"page": page, "offset": at, "length": len(data), "digest": digest}))
                records.append(data)
                at, size = at + len(data), size + len(payload)
                if size >= archive_bytes:
                    yield archive(records, index)
                    records, index, at, size = [], [], 0, 0
        if records:
            yield archive(records, index)

    def archive(records: list[bytes], index: list[str]) -> pa.RecordBatch:
        # Spark's text writer ends each row with a line end, which here is the file's comment.
        body = zip_file([(DATA, records), (INDEX, ["\n".join(index).encode()])], zip64, b"\n")
        return pa.RecordBatch.from_arrays([pa.array([body[:-1]], pa.binary())], names=["body"])

    packed = rows.mapInArrow(pack, "body binary").select(F.col("body").cast("string").alias("value"))
    packed.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)  # a file per archive


class _Ranges:
    """Ranges of bytes of a file that pyarrow can open."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.length = self.file.size()

    def __call__(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under ``path``, with its payload.

    Archives are opened by the tasks and read by ranges. Where only Spark's own readers reach the
    store, each archive is read whole into memory, and the ranges are taken there.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    files = files.filter("length > 0")  # an empty table leaves an empty file

    def records(read, length: int) -> Iterator[dict]:
        members = directory(read, length)
        data, index = members[DATA], members[INDEX]
        if not (data.stored and index.stored):
            raise ValueError("members have to be stored without compression")
        for line in read(index.start, index.size).splitlines():
            row = json.loads(line)
            yield parse_record(read(data.start + row["offset"], row["length"]))

    def rows(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for got in found:
            head = got["headers"]
            kind = head["WARC-Type"]
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and (payload_digest(got["payload"]) != digest or len(got["payload"]) != got["length"]):
                raise ValueError(f"payload of {head['WARC-Record-ID']} does not fit its headers")
            refers = _page_of(head["WARC-Refers-To"]) if kind == "revisit" else None
            payload = got["payload"] if kind == "response" else None
            out.append((_page_of(head["WARC-Record-ID"]), got["length"], digest, kind, refers, payload))
            size += got["length"]
            if size > 8 << 20:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                source = _Ranges(name)
                yield from rows(records(source, source.length))

    def in_memory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                buffer = content.as_buffer()
                yield from rows(records(lambda at, n: buffer.slice(at, n).to_pybytes(), buffer.size))  # noqa: B023

    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"
    if scheme not in ("file", "s3", "s3a", "gs", "hdfs"):
        return files.select("content").mapInArrow(in_memory, schema)
    # One row per archive, dealt out so that a task gets a few of them.
    named = files.select(F.regexp_replace(F.regexp_replace("path", "^file:/*", "file:///"), "^s3a:", "s3:").alias("path"))
    return named.mapInArrow(by_range, schema)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages into archives in the shared folder and read their records back."""
    spark = pages.sparkSession
    path = work_path(spark, "archives")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
