import datetime as dt
import glob

import pytest
from pyspark.sql import types as T

from dayfold.sources import results
from conftest import rows

SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in [
        ("id", T.StringType()), ("k", T.StringType()), ("year", T.IntegerType()), ("month", T.IntegerType()),
        ("date", T.IntegerType()), ("a", T.IntegerType()), ("b", T.StringType()),
        ("created_at", T.TimestampNTZType()), ("updated_at", T.TimestampNTZType()),
    ]
])
KEY = ["k", "year", "month", "date"]
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
BATCH = "k string, year int, month int, date int, a int"


def upsert(spark, path, batch, now, **more):
    return results.upsert_table(spark, path, batch, SCHEMA, KEY, now, {"b": "dflt"}, **more)


def test_upsert_table_touches_only_its_days(spark, frame, folder):
    path = f"{folder}/t"
    upsert(spark, path, frame([("x", 2024, 1, 1, 1), ("y", 2024, 1, 2, 2)], BATCH), T0)
    before = {r[0] for r in spark.read.parquet(path).filter("date = 2").select("_metadata.file_path").collect()}
    upsert(spark, path, frame([("x", 2024, 1, 1, 5), ("z", 2024, 1, 1, 6)], BATCH), T1)
    table = results.read_table(spark, path, SCHEMA)
    assert rows(table, "k", "date", "a", "b", "created_at", "updated_at") == [
        ("x", 1, 5, "dflt", T0, T1), ("y", 2, 2, "dflt", T0, T0), ("z", 1, 6, "dflt", T1, T1),
    ]
    after = {r[0] for r in spark.read.parquet(path).filter("date = 2").select("_metadata.file_path").collect()}
    assert before == after


def test_publish_can_be_repeated(spark, frame, folder):
    path = f"{folder}/t"
    assert upsert(spark, path, frame([("x", 2024, 1, 1, 1)], BATCH), T0) is None
    merged = upsert(spark, path, frame([("y", 2024, 1, 1, 1)], BATCH), T0, keep=True)
    once = rows(results.read_table(spark, path, SCHEMA))
    results.publish(spark, merged, path, SCHEMA)
    assert rows(results.read_table(spark, path, SCHEMA)) == once


def test_only_the_days_of_the_batch_are_read(spark, frame, folder):
    path = f"{folder}/t"
    assert results.read_days(spark, path, SCHEMA, frame([], BATCH)) is None
    upsert(spark, path, frame([("x", 2024, 1, d, d) for d in range(1, 6)], BATCH), T0)
    part = results.read_days(spark, path, SCHEMA, frame([("q", 2024, 1, 2, 0), ("q", 2024, 1, 4, 0), ("q", None, 1, 9, 0)], BATCH))
    assert rows(part, "a") == [(2,), (4,)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1]
    assert results.read_days(spark, path, SCHEMA, frame([("q", 2025, 1, 2, 0)], BATCH)) is None
    upsert(spark, path, frame([("x", 2024, 1, d, -d) for d in range(1, 5)], BATCH), T1)
    assert rows(results.read_table(spark, path, SCHEMA), "a") == [(-1,), (-2,), (-3,), (-4,), (5,)]


def test_intermediate_folders_go(spark, frame, folder):
    import os

    from dayfold.session import shared_dir

    left = lambda: {x for x in os.listdir(shared_dir(spark)) if x.startswith("upsert-")}
    before = left()
    for now in (T0, T1):
        upsert(spark, f"{folder}/t", frame([("x", 2024, 1, 1, 1)], BATCH), now)
    assert left() == before


def test_append_adds(spark, frame, folder):
    path = f"{folder}/t"
    day = frame([("x", 2024, 1, 1, 1)], BATCH)
    results.append_day(day, path)
    results.append_day(day, path)
    assert spark.read.parquet(path).count() == 2


def test_load_classified(spark, frame, folder):
    results.write_result(frame([("m", 2024, 1, 1)], "meta_id string, year int, month int, day int"), f"{folder}/a/b")
    assert results.load_classified(spark, f"{folder}/a/b").count() == 1
    results.write_result(frame([("m",)], "meta_id string"), f"{folder}/c")
    with pytest.raises(ValueError, match="lacks columns"):
        results.load_classified(spark, f"{folder}/c")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        results.load_classified(spark, f"{folder}/none")


def test_empty_batch(spark, frame, folder):
    path = f"{folder}/t"
    upsert(spark, path, frame([("x", 2024, 1, 1, 1)], BATCH), T0)
    upsert(spark, path, frame([], BATCH), T1)
    assert rows(results.read_table(spark, path, SCHEMA), "k", "a") == [("x", 1)]


def test_missing_table_is_empty(spark, folder):
    assert results.read_table(spark, f"{folder}/none", SCHEMA).schema.names == SCHEMA.names


def test_days_are_pruned_as_the_query_runs(spark, frame, folder):
    path = f"{folder}/table"
    schema = "meta_id string, year int, month int, date int"
    table = frame([(f"m{d}{i}", 2025, 1, d) for d in range(1, 11) for i in range(3)], schema)
    results.replace_days(table, path)
    for file in glob.glob(f"{path}/year=2025/month=1/date=5/*.parquet"):  # a day that must not be read
        with open(file, "wb") as out:
            out.write(b"broken")
    frame([("x", 2025, 1, 3), ("y", 2025, 1, 3), ("z", None, 1, 4), ("w", 2030, 1, 4)], schema).write.parquet(f"{folder}/wanted")
    found = results.rows_of_days(spark, path, table.schema, spark.read.parquet(f"{folder}/wanted"))
    assert rows(found, "meta_id", "date") == [(f"m3{i}", 3) for i in range(3)]
    assert "dynamicpruning" in found._jdf.queryExecution().toString().lower()
    empty = results.rows_of_days(spark, f"{folder}/none", table.schema, table)
    assert empty.count() == 0 and empty.columns == table.columns
