import datetime as dt
import io
import os
import tarfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayfold.model import KINDS
from dayfold.operators.quality import in_range, not_null
from dayfold.plans import classify, media
from dayfold.plans.ingest import ingest
from dayfold.sources import archives
from dayfold.sources.results import read_table
from dayfold.streaming.ingest import ingest_stream
from dayfold.streaming.status import current_status, status_stream
from conftest import rows
from test_scoring import make_scorer

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def drop(folder, slot, kind, **columns):
    os.makedirs(folder, exist_ok=True)
    pd.DataFrame(columns).to_parquet(f"{folder}/0_{slot}_{kind}.parquet")


def stored(spark, path, kind="metadata"):
    return read_table(spark, path, KINDS[kind].table_schema)


def test_ingest_two_months(spark, folder):
    root, tables = f"{folder}/in", f"{folder}/tables"
    drop(root, "2025-01-01_00_00", "metadata", meta_id=["a", "b", None], meta_secret=[1, 0, 1], country=["x", "y", "z"])
    drop(root, "2025-01-01_00_10", "metadata", meta_id=["a"], meta_secret=[None])
    drop(root, "2025-01-01_00_00", "comments", meta_id=["a"], cid=["c"], text=["hello"], author_pin=[1.0])
    drop(root, "2025-01-01_00_00", "subtitles", nonsense=["no key"])
    out = ingest(spark, root, tables, T0)
    assert [out[k]["error"] for k in ("metadata", "comments", "subtitles")] == [None] * 3
    assert rows(out["metadata"]["rejects"], "reason", "row_index") == [("null key", 2)]
    assert rows(out["subtitles"]["rejects"], "reason", "detail") == [("null key", '{"nonsense":"no key"}')]
    assert out["comments"]["rejects"].isEmpty()
    assert rows(stored(spark, f"{tables}/metadata"), "meta_id", "meta_secret", "country", "meta_duetenabled",
                "stats_playcount") == [("a", False, None, True, 0), ("b", False, "y", True, 0)]
    assert rows(stored(spark, f"{tables}/comments", "comments"), "cid", "comment_text", "author_pin", "reply_count") == [
        ("c", "hello", True, 0)
    ]
    more = f"{folder}/more"
    drop(more, "2025-01-01_05_00", "metadata", meta_id=["b"], country=["yy"])
    drop(more, "2025-02-01_05_00", "metadata", meta_id=["b"], country=["feb"])
    ingest(spark, more, tables, T1, kinds=["metadata"])
    assert rows(stored(spark, f"{tables}/metadata"), "meta_id", "month", "country", "meta_secret", "created_at", "updated_at") == [
        ("a", 1, None, False, T0, T0), ("b", 1, "yy", False, T0, T1), ("b", 2, "feb", False, T1, T1),
    ]


def test_stream_over_several_runs_equals_batch(spark, folder):
    root, table, state = f"{folder}/in", f"{folder}/table", f"{folder}/state"
    run = lambda: ingest_stream(spark, root, "metadata", table, state, lambda: T0, files_per_batch=1).awaitTermination()
    drop(root, "2025-01-01_00_00", "metadata", meta_id=["a", "b"], stats_playcount=[1, 2])
    run()
    drop(root, "2025-01-01_00_10", "metadata", meta_id=["a", "c"], stats_playcount=[7.0, None])
    with open(f"{root}/0_2025-01-01_00_20_metadata.parquet", "wb") as f:
        f.write(b"broken")
    run()
    run()
    batch = f"{folder}/batch"
    ingest(spark, root, batch, T0, kinds=["metadata"])
    shown = ("meta_id", "year", "month", "date", "stats_playcount")
    assert rows(stored(spark, table), *shown) == rows(stored(spark, f"{batch}/metadata"), *shown)
    assert rows(stored(spark, table), "meta_id", "stats_playcount") == [("a", 7), ("b", 2), ("c", None)]


def test_kinds_without_files_are_no_failure(spark, folder):
    drop(f"{folder}/in", "2025-01-01_00_00", "metadata", meta_id=["a"])
    out = ingest(spark, f"{folder}/in", f"{folder}/tables", T0)
    assert [o["error"] for o in out.values()] == [None] * 3
    assert stored(spark, f"{folder}/tables/metadata").count() == 1


def test_no_row_is_lost_on_the_way(spark, folder):
    root = f"{folder}/in"
    drop(root, "2025-01-01_00_00", "metadata", meta_id=["a", None, None, None, "a"], stats_playcount=["1", "2", "3", "4", "x"])
    pd.DataFrame({"meta_id": ["u", "v"]}).to_parquet(f"{root}/undated_metadata.parquet")
    with open(f"{root}/0_2025-01-01_00_20_metadata.parquet", "wb") as f:
        f.write(b"broken")
    want = [("does not fit: stats_playcount", 1), ("null key", 1), ("null key", 1), ("null key", 1), ("undated", 1), ("undated", 1), ("unreadable file", None)]
    out = ingest(spark, root, f"{folder}/batch", T0, kinds=["metadata"])["metadata"]
    assert rows(out["rejects"], "reason", "rows") == want
    ingest_stream(spark, root, "metadata", f"{folder}/stream", f"{folder}/state", lambda: T0).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/stream_rejects"), "reason", "rows") == want
    for path in ("batch/metadata", "stream"):
        assert rows(stored(spark, f"{folder}/{path}"), "meta_id", "stats_playcount") == [("a", 1)]


def test_report_of_a_load(spark, folder):
    root = f"{folder}/in"
    drop(root, "2025-01-01_00_00", "metadata", meta_id=["a", None, "b", "a"], stats_playcount=["1", "2", "-3", "x"])
    drop(root, "2025-01-01_00_10", "metadata", meta_id=["a", "c"], stats_playcount=["5", None])
    pd.DataFrame({"meta_id": ["u", "v"]}).to_parquet(f"{root}/undated_metadata.parquet")
    with open(f"{root}/0_2025-01-01_00_20_metadata.parquet", "wb") as f:
        f.write(b"broken")
    rules = {"metadata": [in_range("stats_playcount", 0), not_null("stats_playcount")]}
    out = ingest(spark, root, f"{folder}/tables", T0, rules=rules)
    assert out["metadata"]["report"] == {
        "rows_scanned": 8, "rows_refused": 4, "refused": {"undated": 2, "misfits": 1, "null_keys": 1},
        "files_unreadable": 1, "rows_before": 4, "rows_after": 3, "rows_removed": 1,
        "broken": {"stats_playcount in range": 1, "stats_playcount not null": 1}}
    none = dict.fromkeys(("rows_scanned", "rows_refused", "files_unreadable", "rows_before", "rows_after", "rows_removed"), 0)
    for kind in ("comments", "subtitles"):  # no files
        assert out[kind]["report"] == {**none, "refused": {"undated": 0, "misfits": 0, "null_keys": 0}, "broken": {}}
    again = ingest(spark, root, f"{folder}/tables", T1, kinds=["metadata"])["metadata"]["report"]
    assert (again["rows_before"], again["rows_after"], again["broken"]) == (4, 3, {})


@pytest.mark.parametrize("per_batch", [1, 5000])
def test_stream_does_not_depend_on_the_order_of_arrival(spark, folder, per_batch):
    root, table, state = f"{folder}/in", f"{folder}/table", f"{folder}/state"
    for slot, value in (("2025-01-01_00_20", 3), ("2025-01-01_00_00", 1), ("2025-01-01_00_10", 2)):
        drop(root, slot, "metadata", meta_id=["a", slot], stats_playcount=[value, value])
        if per_batch == 1:
            ingest_stream(spark, root, "metadata", table, state, lambda: T0, per_batch).awaitTermination()
    ingest_stream(spark, root, "metadata", table, state, lambda: T0, per_batch).awaitTermination()
    assert rows(stored(spark, table).filter("meta_id = 'a'"), "stats_playcount") == [(3,)]
    assert stored(spark, table).count() == 4


def test_merge_without_fitting_drops_is_empty(spark, folder):
    frame = spark.createDataFrame([("a", 2025, 1, 1, "t")], "meta_id string, year int, month int, day int, content string")
    frame.write.parquet(f"{folder}/classified")
    drop(f"{folder}/in", "2025-02-01_00_00", "metadata", meta_id=["a"])
    merged = classify.merge(spark, f"{folder}/classified", f"{folder}/in", f"{folder}/out")
    assert merged.count() == 0 and {"meta_id", "content", "country"} <= set(merged.columns)


def test_status_changes_are_put_together(spark, folder, frame, monkeypatch):
    from dayfold.streaming import status

    monkeypatch.setattr(status, "BATCHES_KEPT", 2)
    source, out, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    for i in range(5):
        frame([(i % 3, f"s{i}", dt.datetime(2024, 1, 1, 0, i), i, None, None, None)], EVENT).write.mode("append").parquet(source)
        status_stream(spark.readStream.schema(EVENT).parquet(source), out, state, ["day"]).awaitTermination()
    assert rows(current_status(spark, out, ["day"]), "day", "status") == [(0, "s3"), (1, "s4"), (2, "s2")]
    assert len([x for x in os.listdir(out) if x.startswith("epoch=")]) == 2


EVENT = ("day int, status string, ts timestamp_ntz, seq long, transfer_task_id string, job_id long, error_message string")


def test_status_stream_takes_late_events(spark, folder, frame):
    source, out, state = f"{folder}/in", f"{folder}/out", f"{folder}/state"
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)

    def run():
        events = spark.readStream.schema(EVENT).parquet(source)
        status_stream(events, out, state, ["day"]).awaitTermination()
        return rows(current_status(spark, out, ["day"]), "day", "status", "transfer_start", "error_message")

    frame([(1, "processing", at(5), 5, None, None, "e")], EVENT).write.parquet(source)
    assert run() == [(1, "processing", None, "e")]
    frame([(1, "transferring", at(1), 1, None, None, None), (2, "pending", at(0), 1, None, None, None)],
          EVENT).write.mode("append").parquet(source)
    assert run() == [(1, "processing", at(1), "e"), (2, "pending", None, None)]


def test_classify_and_merge(spark, folder):
    root, path = f"{folder}/in", f"{folder}/classified"
    drop(root, "2025-01-01_00_00", "subtitles", meta_id=["a", "b", "c"], content=["x", " ", "bad"])
    drop(root, "2025-01-02_00_00", "subtitles", meta_id=["a"], content=["yy"])
    drop(f"{root}/deep", "2025-01-01_00_00", "metadata", meta_id=["a", "c"], content=["m1", "m2"])
    drop(f"{root}/deep", "2025-01-03_00_00", "metadata", meta_id=["a"], content=["m3"])
    done, failed = classify.classify(spark, root, make_scorer, path, rows_per_save=2)
    assert rows(done, "meta_id", "day", "classification") == [("a", 1, 1), ("a", 2, 0)]
    assert rows(failed, "meta_id", "error") == [("c", "bad text")]
    assert done.columns == classify.RESULT_COLUMNS
    done.write.parquet(f"{folder}/done")
    merged = classify.merge(spark, f"{folder}/done", root, f"{folder}/a/merged")
    assert rows(merged, "meta_id", "day", "content_x", "content_y") == [("a", 1, "x", "m1")]


def tar(path, **members):
    with tarfile.open(path, "w:xz") as t:
        for name, data in members.items():
            info = tarfile.TarInfo(name.replace("__", "/").replace("_mp3", ".mp3").replace("_txt", ".txt"))
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture
def tars(folder):
    tar(f"{folder}/0_2025-01-31_23_50.tar.xz", d__one_mp3=b"12", two_txt=b"3", three_mp3=b"456")
    tar(f"{folder}/0_2025-01-31_23_40.tar.xz", four_mp3=os.urandom(50_000))
    whole = open(f"{folder}/0_2025-01-31_23_40.tar.xz", "rb").read()
    with open(f"{folder}/0_2025-01-31_23_30.tar.xz", "wb") as f:
        f.write(whole[:30_000])
    return folder


def test_archives(spark, tars, monkeypatch):
    monkeypatch.setattr(archives, "BATCH_BYTES", 1)
    found = archives.scan_archives(spark, tars)
    assert found.count() == 3
    members, failed = archives.explode_archives(found, content=True)
    for t in os.listdir(tars):  # read once: nothing is opened again
        os.rename(f"{tars}/{t}", f"{tars}/gone-{t}")
    assert rows(members, "member", "size", F.length("content")) == [
        ("d/one.mp3", 2, 2), ("four.mp3", 50000, 50000), ("three.mp3", 3, 3),
    ]
    assert [r["archive"].rsplit("/", 1)[1] for r in failed.collect()] == ["0_2025-01-31_23_30.tar.xz"]


def test_media_day(spark, tars, frame):
    members, _ = archives.explode_archives(archives.scan_archives(spark, tars))
    files = media.member_files(members)
    assert rows(files, "meta_id", "year", "month", "date", "slot", "output_path") == [
        ("four", 2025, 1, 31, "23_40", "0_2025-01-31_23_40/four.opus"),
        ("one", 2025, 1, 31, "23_50", "0_2025-01-31_23_50/one.opus"),
        ("three", 2025, 1, 31, "23_50", "0_2025-01-31_23_50/three.opus"),
    ]
    left = media.to_convert(files, frame([("0_2025-01-31_23_50/one.opus",)], "output_path string"))
    assert rows(left, "meta_id") == [("four",), ("three",)]
    outcomes = files.select("archive", "filename").withColumns({
        "error": F.when(F.col("filename") == "one.mp3", "conversion failed"),
        "transcript_text": F.when(F.col("filename") == "four.mp3", "hello world"),
        "word_count": F.lit(2).cast("long"), "duration_seconds": F.lit(1.5),
    })
    stored_files, transcripts = media.record_batch(files, outcomes, f"{tars}/recorded")
    assert rows(stored_files, "meta_id", "file_path") == [
        ("four", "audio/2025/01/31/23_40/four.opus"), ("three", "audio/2025/01/31/23_50/three.opus"),
    ]
    joined = transcripts.join(stored_files, transcripts.audio_file_id == stored_files.id)
    assert rows(joined, "meta_id", "transcript_text") == [("four", "hello world")]


def test_manifest(spark, tars):
    listing = archives.names_of(archives.scan_archives(spark, tars))
    found = archives.manifest([listing, listing.limit(0)], "2025-01-31", "s/", "t/")
    assert rows(found)[0] == ("0_2025-01-31_23_30.tar.xz", "s/0_2025-01-31_23_30.tar.xz", "t/0_2025-01-31_23_30.tar.xz")
    assert rows(archives.manifest_status(found)) == [(3, "READY")]
    none = archives.manifest([listing], "2026-01-01")
    assert rows(archives.manifest_status(none)) == [(0, "FAILED")]
