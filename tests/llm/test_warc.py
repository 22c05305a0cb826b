import base64
import hashlib
import io
import zipfile

import pytest

from dayfold.llm import queries, warc

SCHEMA = "page_id long, url string, html string"


def expected(pages, least=0):
    body = {i: (html or "").encode() for i, (_, _, html) in enumerate(pages)}
    first = {}
    for i, (page, _, _) in enumerate(pages):
        if page is not None:
            first[body[i]] = min(page, first.get(body[i], page))
    out = []
    for i, (page, _, _) in enumerate(pages):
        digest = base64.b32encode(hashlib.sha1(body[i]).digest()).decode()
        again = len(body[i]) >= least and list(body.values()).count(body[i]) > 1 and page != first.get(body[i])
        out.append((page, len(body[i]), digest, "revisit" if again else "response", first.get(body[i]) if again else None))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a/", "<p>same</p>"), (3, "http://b/", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "http://b/", "<p>same</p>"),
    (1, "http://c/\r\nX: y", "Ü\r\n\r\n\x00" * 50), (2, "", None), (7, "http://d/", ""), (None, "http://e/", "alone"),
    (None, "http://f/", "<p>same</p>"), (11, "http://g/", "z" * 300_000),
]


@pytest.mark.parametrize("options", [{}, {"zip64": True}, {"archive_bytes": 1}, {"least_bytes": 5}])
def test_round_trip(spark, options):
    got = warc.round_trip(spark.createDataFrame(PAGES, SCHEMA), **options)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == expected(PAGES, options.get("least_bytes", 0))
    bodies = {r["page_id"]: bytes(r["payload"]).decode() for r in got.collect() if r["payload"] is not None}
    assert bodies[1] == PAGES[4][2] and bodies[11] == PAGES[9][2]


def test_store_that_only_spark_reads(spark, folder):
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), f"file://{folder}/a", archive_bytes=50)
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.t.link./x", f"file://{folder}")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = warc.read_archives(spark, "viewfs://t/x/a").select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_are_plain_zip_files(zip64):
    members = [("a/x", [b"one", b"two"]), ("ü", [b""]), ("end", [b"PK\x05\x06" * 9])]
    data = warc.zip_file(members, zip64, b"\n")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None
        assert [(n, z.read(n)) for n in z.namelist()] == [(n, b"".join(p)) for n, p in members]
    found = warc.directory(lambda at, n: data[at : at + n], len(data))
    assert {n: data[m.start : m.start + m.size] for n, m in found.items()} == {n: b"".join(p) for n, p in members}
    assert all(m.stored for m in found.values())


def test_directory_reads_foreign_archives_and_only_what_it_needs():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr(zipfile.ZipInfo("big"), b"x" * 1_000_000)
        z.writestr(zipfile.ZipInfo("packed"), b"y" * 1000, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"a comment PK\x05\x06"
    data, read = raw.getvalue(), []
    found = warc.directory(lambda at, n: read.append(n) or data[at : at + n], len(data))
    assert found["big"].size == 1_000_000 and found["big"].stored and not found["packed"].stored
    assert sum(read) < 70_000
    with pytest.raises(ValueError):
        warc.directory(lambda at, n: b"not a zip"[at : at + n], 9)


def test_query_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.QUERIES["op7_warc_archives"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == expected(pages)
