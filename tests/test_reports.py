import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayfold.operators import ranking, reports
from dayfold.plans.monitor import recent_completions, status_report
from conftest import rows

DAY = "year int, month int, date int"


def test_status_summary(frame):
    q = frame([(2024, 1, 9, "a"), (2024, 1, 10, "a"), (2023, 12, 31, "b"), (2024, 1, 1, None)], f"{DAY}, status string")
    assert rows(reports.status_summary(q)) == [
        ("a", 2, "2024-01-09", "2024-01-10"), ("b", 1, "2023-12-31", "2023-12-31"),
        (None, 1, "2024-01-01", "2024-01-01"),
    ]


def test_class_summary(frame):
    assert rows(reports.class_summary(frame([(0,), (0,), (1,), (None,)], "c int"), "c")) == [(0, 2, 50.0), (1, 1, 25.0)]
    assert rows(reports.class_summary(frame([], "c int"), "c")) == [(0, 0, None), (1, 0, None)]


def test_day_statistics(frame):
    files = frame([(2024, 1, 1)] * 2, DAY)
    transcripts = frame([(2024, 1, 1)], DAY)
    metadata = frame([(2024, 1, 2)], DAY)
    queue = frame([(2024, 1, 1, "completed", None, None, "e"), (2024, 1, 3, None, None, None, None)],
                  f"{DAY}, status string, processing_start timestamp_ntz, processing_end timestamp_ntz, error_message string")
    out = reports.day_statistics(files, transcripts, metadata, queue)
    assert rows(out, "date", "audio_files", "transcripts", "metadata_records", "queue_status", "error_message") == [
        ("2024-01-01", 2, 1, 0, "completed", "e"),
        ("2024-01-02", 0, 0, 1, "not_found", None),
        ("2024-01-03", 0, 0, 0, None, None),
    ]


def test_workers(frame):
    states = ["COMPLETED", "FAILED", "TIMEOUT", "CANCELLED", "NODE_FAIL", "RUNNING", "PENDING", "CONFIGURING", "ODD", None]
    out = reports.worker_rollup(frame([(1, s) for s in states], "master_job_id int, state string"))
    assert rows(out) == [(1, 10, 1, 4, 3, 5)]


def test_master_progress(frame):
    df = frame([(1, 5, 0), (1, None, 2)], "master_job_id int, files_processed int, files_failed int")
    assert rows(reports.master_progress(df)) == [(1, 2, 5, 2)]


def test_archives(frame):
    members = frame([("a", True), ("a", False), ("b", True), ("c", None)], "archive string, ok boolean")
    out = reports.archive_outcomes(members, "archive", F.col("ok"))
    assert rows(out) == [("a", 2, 1, 1, True), ("b", 1, 1, 0, False), ("c", 1, 0, 1, True)]
    assert rows(reports.archive_totals(out)) == [(1, 2, 2, 2)]


def test_final_status(frame):
    df = frame([(5, 0), (5, 1), (0, 3), (0, 0)], "processed_count long, failed_count long")
    assert rows(reports.with_final_status(df)) == [
        (0, 0, "completed", None),
        (0, 3, "processing_failed", "Failed files: 3, Processed: 0"),
        (5, 0, "completed", None),
        (5, 1, "completed_with_errors", "Failed files: 1, Processed: 5"),
    ]


def test_gate_rounds_down(frame):
    expected = frame([(2024, 1, 1, 11), (2024, 1, 2, 10), (2024, 1, 3, 0)], f"{DAY}, expected long")
    arrived = frame([(2024, 1, 1)] * 9 + [(2024, 1, 2)] * 8, DAY)
    assert rows(reports.completeness_gate(expected, arrived), "date", "needed", "arrived", "status") == [
        (1, 9, 9, "ready_to_process"), (2, 9, 8, "transfer_failed"), (3, 0, 0, "ready_to_process"),
    ]


@pytest.mark.parametrize("piece", [1, 2, 1024])
def test_assembly(frame, monkeypatch, piece):
    monkeypatch.setattr(reports, "SEGMENTS_PER_PIECE", piece)
    words = [f" w{i} x\n" for i in range(7)]
    df = frame([("f", i, w, 8000) for i, w in reversed(list(enumerate(words)))] + [("g", 0, None, 16000)],
               "f string, at int, text string, samples long")
    out = reports.assemble_transcripts(df, ["f"], "at", "text", "samples")
    assert rows(out) == [("f", " ".join(w.strip() for w in words), 14, 7, 3.5), ("g", "", 0, 1, 1.0)]
    whole = reports.transcripts_of(frame([("f",), ("h",)], "f string"), out.select("f", "transcript_text", "word_count"), ["f"])
    assert rows(whole, "f", "word_count") == [("f", 14), ("h", 0)]


def test_ordered_labels(frame):
    df = frame([("s", "b", 2), ("s", "a", 3), ("s", "c", 1), ("s", "b", 2)], "t string, label string, at int")
    assert rows(reports.ordered_labels(df, ["t"], "label", "at")) == [("s", "c, b, a")]


def test_profile_and_versions(frame):
    df = frame([("3.0", dt.datetime(2024, 2, 1)), ("3.1", dt.datetime(2024, 1, 1))], "version string, applied_at timestamp_ntz")
    assert rows(reports.table_profile({"v": df, "e": df.limit(0)})) == [("e", 0, 2), ("v", 2, 2)]
    assert rows(reports.latest_version(df)) == [("3.1", "3.0")]


def test_missing_and_per_file(frame):
    df = frame([("a", "f"), (" ", "f"), (None, "g")], "t string, source_filename string")
    assert rows(reports.missing_text(df, "t")) == [(3, 1, 2)]
    assert rows(reports.rows_per_file(df)) == [("f", 2), ("g", 1)]


def test_recent_completions(frame):
    at = lambda h: dt.datetime(2024, 5, 1) + dt.timedelta(hours=h)
    q = frame(
        [(2024, 1, d, "completed", at(0), at(d)) for d in range(1, 13)]
        + [(2024, 1, 20, "completed", at(0), None), (2024, 1, 21, "pending", at(0), at(99))],
        f"{DAY}, status string, processing_start timestamp_ntz, processing_end timestamp_ntz",
    )
    files = frame([(2024, 1, 12)] * 3, DAY)
    out = {r["date"]: r for r in recent_completions(q, files).collect()}
    assert len(out) == 10 and "2024-01-20" in out and "2024-01-03" not in out and "2024-01-21" not in out
    assert (out["2024-01-12"]["files"], out["2024-01-12"]["duration"]) == (3, "12:00:00")
    assert out["2024-01-20"]["duration"] is None and out["2024-01-20"]["files"] == 0
    assert set(status_report(q, files)) == {"status_summary", "recent_completions"}


def test_chunks(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    out = ranking.with_chunks(df, ["k", "id"], 12)
    expected = [r["id"] for r in df.orderBy("k", "id").collect()]
    got = out.orderBy("row_no").collect()
    assert [r["row_no"] for r in got] == list(range(100)) and [r["id"] for r in got] == expected
    assert [r["chunk"] for r in got] == [i // 12 for i in range(100)]


def test_row_numbers_when_one_value_is_a_third(spark):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") < 1000, 7).otherwise(F.col("id")))
    out = ranking.with_row_number(df, ["k", "id"])
    assert out.agg(F.countDistinct("row_no"), F.min("row_no"), F.max("row_no")).first()[:] == (3000, 0, 2999)


def test_scalar_and_latest(frame):
    df = frame([("a", 1), ("b", None), ("c", 3)], "k string, at int")
    assert rows(ranking.scalar(df.filter("k = 'a'"), "k", "z")) == [("a",)]
    assert rows(ranking.scalar(df.limit(0), "k", "z")) == [("z",)]
    assert [r["k"] for r in ranking.latest(df, "at", 2).collect()] == ["b", "c"]
    assert rows(ranking.first_distinct(df.union(df), ["k"], ["k"], 2)) == [("a",), ("b",)]
