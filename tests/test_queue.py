import datetime as dt

from pyspark.sql import functions as F

from dayfold.operators import queue
from dayfold.sources.intake import parse_lines, read_lines, read_queue
from conftest import rows

DAY = "year int, month int, date int"
EVENT = f"{DAY}, status string, ts timestamp_ntz, seq long, transfer_task_id string, job_id long, error_message string"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def test_fold(frame):
    d = (2024, 1, 1)
    events = frame([
        (*d, "completed", at(9), 9, None, None, None),
        (*d, "transferring", at(1), 1, None, None, None),
        (*d, "transferring", at(2), 2, "task", None, None),
        (*d, "ready_to_process", at(3), 3, None, None, None),
        (*d, "processing", at(4), 4, None, 77, None),
        (*d, "processing_failed", at(5), 5, None, None, "broke"),
        (*d, "processing", at(9), 8, None, None, None),
        (2024, 1, 2, "pending", at(0), 1, None, None, None),
    ], EVENT)
    out = {r["date"]: r for r in queue.fold_status(events).collect()}
    assert tuple(out[1])[3:] == ("completed", at(2), at(3), at(9), at(9), "task", 77, "broke")
    assert tuple(out[2])[3:] == ("pending", None, None, None, None, None, None, None)


QUEUE = f"{DAY}, location string, status string"


def test_dispatchable(frame):
    q = frame([
        (2024, 1, 3, "z", "pending"), (2024, 1, 1, "z", "pending"), (2024, 1, 1, "z", "processing"),
        (2024, 1, 2, "z", "pending"), (2024, 1, 2, "z", "pending"), (2024, 1, 4, "z", "transferring"),
        (2024, 1, 5, "z", "pending"),
    ], QUEUE)
    assert rows(queue.dispatchable(q, 2), "date") == [(2,), (3,)]
    assert rows(queue.running_days(q), "date") == [(1,), (4,)]


def test_add_entries_and_location(frame):
    q = frame([(2024, 1, 1, "basel", "completed")], QUEUE)
    new = frame([(2024, 1, 1, "z", 1), (2024, 1, 2, "geneva", 3), (2024, 1, 2, "z", 2)], f"{DAY}, location string, line_no long")
    out = queue.add_entries(q, new, ["line_no"])
    assert rows(out) == [(2024, 1, 1, "basel", "completed"), (2024, 1, 2, "z", "pending")]
    assert rows(queue.location_of(out, 2024, 1, 1, "zurich")) == [("basel",)]
    assert rows(queue.location_of(out, 2024, 9, 1, "zurich")) == [("zurich",)]


def test_day_outcome(frame):
    df = frame([(0, 0, False), (3, 0, False), (3, 1, False), (3, 0, True)], "workers long, failed long, late boolean")
    assert rows(queue.day_outcome(df, F.col("late")), "status", "error_message") == sorted([
        ("processing_failed", "No tar.xz files found"), ("completed", None),
        ("completed_with_errors", "1 worker jobs failed"), ("processing_failed", "Worker jobs timed out"),
    ], key=repr)


INTAKE = """# a comment
2025, january, 25, zurich

  2025, SEPT, 31 , new town
2025, 2, 31, zurich
2025, smarch, 1, z
1999, jan, 1, z
2025, jan, 32, z
2025, jan, 1
x, jan, 1, z
1999, smarch, 1, z
2025, 13, 1, z
"""


def test_intake(spark, folder):
    with open(f"{folder}/q.txt", "w") as f:
        f.write(INTAKE)
    entries, rejects = read_queue(spark, f"{folder}/q.txt")
    assert rows(entries, "line_no", "year", "month", "date", "location") == [
        (2, 2025, 1, 25, "zurich"), (4, 2025, 9, 31, "new town"), (5, 2025, 2, 31, "zurich"),
    ]
    assert dict(rows(rejects, "line_no", "reason")) == {
        6: "bad_month", 7: "year_range", 8: "day_range", 9: "field_count", 10: "not_integer",
        11: "bad_month", 12: "bad_month",
    }


def test_line_numbers_over_blocks(spark, folder):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(2000)]
    for name in "ab":
        with open(f"{folder}/{name}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = read_lines(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in "ab":
        mine = sorted((r["line_no"], r["line"]) for r in got if r["file"].endswith(f"{name}.txt"))
        assert mine == [(i + 1, line) for i, line in enumerate(lines)]


def test_parse_without_extras(frame):
    entries, rejects = parse_lines(frame([("2025,1,2,a",), (None,)], "line string"))
    assert rows(entries) == [(2025, 1, 2, "a")] and rejects.isEmpty()
