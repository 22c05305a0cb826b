import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from dayfold.operators import keyed
from conftest import rows

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
TARGET = "id string, k string, d int, a int, b string, created_at timestamp_ntz, updated_at timestamp_ntz"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=12))
def test_keep_last_matches_pandas(spark, keys):
    data = [(k, d, i) for i, (k, d) in enumerate(keys)]
    out = keyed.keep_last(spark.createDataFrame(data, "k string, d int, i int"), ["k", "d"], ["i"])
    expected = pd.DataFrame(data, columns=["k", "d", "i"], dtype=object).drop_duplicates(["k", "d"], keep="last")
    assert sorted(r["i"] for r in out.collect()) == sorted(expected["i"])
    assert rows(keyed.keep_last(out, ["k", "d"], ["i"])) == rows(out)


def test_keep_last_limits_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    plan = keyed.keep_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[1] and "WindowGroupLimit" in plan.split("Exchange")[1]


def test_keep_first(frame):
    df = frame([("x", 2), ("x", 1), ("y", 3)], "k string, i int")
    assert rows(keyed.keep_first(df, ["k"], ["i"])) == [("x", 1), ("y", 3)]


def test_dedup_report(frame):
    df = frame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, d int")
    assert rows(keyed.dedup_report(df, ["k", "d"])) == [(4, 3, 1)]
    assert rows(keyed.dedup_report(df.limit(0), ["k", "d"])) == [(0, 0, 0)]


def target(frame):
    return frame(
        [("i1", "x", 1, 10, "old", T0, T0), ("i2", "y", 1, 20, "keep", T0, T0)], TARGET
    )


def test_upsert(frame):
    batch = frame([("x", 1, None), ("z", 2, 30)], "k string, d int, a int")
    out = {r["k"]: r for r in keyed.upsert(target(frame), batch, ["k", "d"], T1, {"b": "new", "a": 5}).collect()}
    assert len(out) == 3
    assert tuple(out["x"])[:5] == ("i1", "x", 1, None, "old")
    assert (out["x"]["created_at"], out["x"]["updated_at"]) == (T0, T1)
    assert tuple(out["y"]) == ("i2", "y", 1, 20, "keep", T0, T0)
    assert (out["z"]["a"], out["z"]["b"], out["z"]["created_at"], out["z"]["updated_at"]) == (30, "new", T1, T1)
    assert len(out["z"]["id"]) == 64


def test_upsert_twice_is_once(frame):
    batch = frame([("x", 1, 7), ("z", 2, 30)], "k string, d int, a int")
    once = keyed.upsert(target(frame), batch, ["k", "d"], T1)
    assert rows(keyed.upsert(once, batch, ["k", "d"], T1)) == rows(once)


def test_upsert_refuses_foreign_columns(frame):
    with pytest.raises(ValueError, match="lacks"):
        keyed.upsert(target(frame), frame([("x", 1, 1)], "k string, d int, q int"), ["k", "d"], T1)


def test_split_null_keys(frame):
    ok, aside = keyed.split_null_keys(frame([("x", 1), (None, 1), ("y", None)], "k string, d int"), ["k", "d"])
    assert rows(ok) == [("x", 1)] and aside.count() == 2


def test_insert_absent(frame):
    have = frame([(1, "zurich", "completed")], "day int, location string, status string")
    batch = frame([(1, "basel", 1), (2, "geneva", 3), (2, "basel", 2)], "day int, location string, line int")
    out = keyed.insert_absent(have, batch, ["day"], ["line"], {"status": "pending"})
    assert rows(out) == [(1, "zurich", "completed"), (2, "basel", "pending")]


def test_skip_existing(frame):
    have = frame([(1, "a"), (1, "a")], "d int, l string")
    fresh, skipped = keyed.skip_existing(have, frame([(1, "a"), (1, "b")], "d int, l string"), ["d", "l"])
    assert rows(fresh) == [(1, "b")] and rows(skipped) == [(1, "a")]


def test_pending(frame):
    items = frame([(1,), (2,), (None,)], "k int")
    assert rows(keyed.pending(items, frame([(1,), (1,)], "k int"), "k")) == [(2,), (None,)]


def test_delete_cascade(frame):
    parents = frame([(1, "x"), (2, "y"), (3, None)], "id int, s string")
    children = frame([(10, 1), (11, 2), (12, None)], "c int, p int")
    kept, left = keyed.delete_cascade(parents, children, "id", "p", F.col("s") == "x")
    assert rows(kept, "id") == [(2,), (3,)] and rows(left, "c") == [(11,), (12,)]


def test_defaults_only_for_absent_columns(frame):
    df = keyed.with_defaults(frame([(None,)], "a int"), {"a": 1, "b": 2})
    assert rows(df) == [(None, 2)]
