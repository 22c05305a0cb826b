import datetime as dt

import pytest

from conftest import rows
from dayfold.plans import day_run
from dayfold.sources import results

NOW = dt.datetime(2024, 3, 1)
DAYS = [(2024, 1, 1), (2024, 1, 2), (2024, 1, 3)]
MEMBERS = [  # day 3 has no archive
    (f"m{d}{i}", 2024, 1, d, "00_00", f"m{d}{i}.mp3", f"out/m{d}{i}.opus", 10 * i, f"0_2024-01-0{d}_00_00.tar.xz")
    for d in (1, 2) for i in range(3)]
SCHEMA = (
    "meta_id string, year int, month int, date int, slot string, filename string, output_path string, "
    "file_size_bytes long, archive string")
OUTCOMES = "archive string, filename string, error string, transcript_text string, word_count long, duration_seconds double"


def made(frame):
    days = frame(DAYS, "year int, month int, date int")
    outcomes = [(m[8], m[5], "broken" if m[0] == "m21" else None, f"text of {m[0]}", 3, 1.5) for m in MEMBERS if m[0] != "m22"]
    return days, frame(MEMBERS, SCHEMA), frame(outcomes, OUTCOMES)


def stored(spark, root):
    return {n: rows(day_run.finished_rows(spark, root, n, n)) for n in ("audio_files", "transcripts")} | {
        "queue": rows(day_run.queue_of(spark, root), "date", "status", "error_message")}


def test_whole_run(spark, frame, folder):
    days, members, outcomes = made(frame)
    assert day_run.media_run(spark, days, members, outcomes, folder, "r1", NOW) == ["started", "audio_files", "transcripts", "finished"]
    out = stored(spark, folder)
    assert len(out["audio_files"]) == len(out["transcripts"]) == 4
    assert out["queue"] == [
        (1, "completed", None), (2, "completed_with_errors", "Failed files: 2, Processed: 1"),
        (3, "processing_failed", "No tar.xz files found")]
    assert day_run.media_run(spark, days, members, outcomes, folder, "r2", NOW) == []
    assert stored(spark, folder) == out


@pytest.mark.parametrize("done", range(4))
def test_a_killed_run_is_taken_up(spark, frame, folder, done):
    days, members, outcomes = made(frame)
    day_run.media_run(spark, days, members, outcomes, f"{folder}/whole", "r", NOW)
    steps = day_run.media_steps(members, outcomes, f"{folder}/part", "r1", NOW)

    def killed(left):
        steps[done][1](left)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        day_run.run_steps(spark, days, [*steps[:done], (steps[done][0], killed)], f"{folder}/part", "r1", NOW)
    assert day_run.media_run(spark, days, members, outcomes, f"{folder}/part", "r2", NOW) == [n for n, _ in steps[done:]]
    assert stored(spark, f"{folder}/part") == stored(spark, f"{folder}/whole")
    assert spark.read.parquet(f"{folder}/part/ledger").count() == 12


def test_days_that_come_later(spark, frame, folder):
    days, members, outcomes = made(frame)
    day_run.media_run(spark, days.filter("date = 1"), members, outcomes, folder, "r1", NOW)
    assert len(stored(spark, folder)["audio_files"]) == 3
    day_run.media_run(spark, days, members, outcomes, folder, "r2", NOW)
    assert len(stored(spark, folder)["audio_files"]) == 4
    ledger = spark.read.parquet(f"{folder}/ledger")
    assert rows(ledger.groupBy("run").count()) == [("r1", 4), ("r2", 8)]


def test_a_batch_is_appended_once(spark, frame, folder):
    path, schema = f"{folder}/t", "v string, year int, month int, date int"
    one, two = frame([("a", 2024, 1, 1), ("b", 2024, 1, 2)], schema), frame([("c", 2024, 1, 1)], schema)
    assert results.read_batches(spark, path, one.schema).count() == 0
    results.append_batch(one, path, "1")
    results.append_batch(one, path, "1")
    results.append_batch(two, path, "1e2")
    assert rows(results.read_batches(spark, path, one.schema), "v") == [("a",), ("b",), ("c",)]
    results.append_batch(two.limit(0), path, "1")
    results.append_batch(two, path, "third")
    assert rows(results.read_batches(spark, path, one.schema), "v") == [("c",), ("c",)]
    with pytest.raises(ValueError, match="batch id"):
        results.append_batch(one, path, "a/b")


def test_an_append_that_fails_changes_nothing(spark, frame, folder, monkeypatch):
    path, schema = f"{folder}/t", "v string, year int, month int, date int"
    one, two = frame([("a", 2024, 1, 1)], schema), frame([("b", 2024, 1, 1), ("c", 2024, 1, 3)], schema)
    results.append_batch(one, path, "x")
    monkeypatch.setattr(results.time, "time_ns", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        results.append_batch(two, path, "x")
    monkeypatch.undo()
    assert rows(results.read_batches(spark, path, one.schema), "v") == [("a",)]
    query = results.read_batches(spark, path, one.schema)._jdf.queryExecution()
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")
    assert "dynamicpruning" in plan.lower()
    results.append_batch(two, path, "x")
    assert rows(results.read_batches(spark, path, one.schema), "v") == [("b",), ("c",)]
