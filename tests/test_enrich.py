import pandas as pd
import pytest

from dayfold.operators import enrich, skew
from dayfold.session import shared_dir
from conftest import rows

C = "meta_id string, year int, month int, day int, label int, source string, n int"
M = "meta_id string, year int, month int, day int, source string, title string"
CLASSIFIED = [
    ("a", 2024, 1, 1, 1, "s", 1), ("a", 2024, 1, 1, 0, "s", 2), ("b", 2024, 1, 1, 1, "s", 3),
    (None, 2024, 1, 1, 1, "s", 4), ("a", 2024, 1, None, 1, "s", 5),
] + [("hot", 2024, 1, 2, 1, "s", 100 + i) for i in range(40)]
METADATA = [
    ("a", 2024, 1, 1, "m", "t1"), ("a", 2024, 1, 1, "m", "t2"), (None, 2024, 1, 1, "m", "t3"),
    ("a", 2024, 1, None, "m", "t4"), ("c", 2024, 1, 1, "m", "t5"),
] + [("hot", 2024, 1, 2, "m", f"h{i}") for i in range(15)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 20, 10, 1, 0])
def test_classified_join_matches_pandas(frame, hot_rows):
    """Whether no key, the left side, both sides or every key is hot."""
    out = enrich.classified_join(frame(CLASSIFIED, C), frame(METADATA, M), hot_rows=hot_rows)
    assert out.columns == ["meta_id", "year", "month", "day", "label", "source_x", "n", "source_y", "title"]
    left = pd.DataFrame(CLASSIFIED, columns=[c.split()[0] for c in C.split(", ")])
    right = pd.DataFrame(METADATA, columns=[c.split()[0] for c in M.split(", ")])
    both = left[left.day.notna()].merge(right[right.day.notna()], on=["meta_id", "year", "month", "day"])
    assert out.count() == len(both) == 4 + 1 + 40 * 15
    assert {(r["n"], r["title"]) for r in out.collect()} == set(zip(both["n"], both["title"]))


def test_right_side_hot_only(frame):
    left = frame([("k", 1)], "k string, a int")
    right = frame([("k", i) for i in range(50)] + [("q", 1)], "k string, b int")
    out = skew.salted_inner_join(left, right, ["k"], hot_rows=10)
    assert rows(out, "b") == sorted([(i,) for i in range(50)], key=repr)


def test_hot_keys(frame):
    df = frame([("a",)] * 10 + [(None,)] * 4 + [("b",)], "k string")
    other = frame([("b",)] * 7, "k string")
    hot = skew.hot_keys(df, other, ["k"], {"k": "string"}, 3)
    hashes = df.select("k", skew.key_hash(["k"], {"k": "string"}).alias("__hash")).distinct()
    assert rows(hashes.join(hot, "__hash"), "k", "__left", "__right") == [("a", 4, 1), ("b", 1, 3), (None, 2, 1)]


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 1000)
    left = spark.range(6000).selectExpr("id % 1500 AS k", "id AS a")
    right = spark.range(3000).selectExpr("id % 1500 AS k", "id AS b")
    out = skew.salted_inner_join(left, right, ["k"], hot_rows=2)
    assert out.count() == 1500 * 4 * 2 and out.distinct().count() == 12000


def test_counts_and_join_use_no_single_task(spark):
    left, right = spark.range(100).selectExpr("id % 7 AS k", "id AS a"), spark.range(50).selectExpr("id % 7 AS k", "id AS b")
    plan = skew.salted_inner_join(left, right, ["k"], hot_rows=5)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("hot_rows", [100, 5])
def test_join_of_different_number_types(frame, hot_rows):
    left = frame([(1, i) for i in range(9)] + [(2, 99)], "k int, a int")
    right = frame([(1.0, i) for i in range(7)] + [(-0.0, 5)], "k double, b int")
    out = skew.salted_inner_join(left, right, ["k"], hot_rows=hot_rows)
    assert out.count() == 63 and out.distinct().count() == 63


def test_join_refuses_mixed_and_missing_keys(frame):
    numbers = frame([(1, 2024, 1, 1)], "meta_id int, year int, month int, day int")
    with pytest.raises(TypeError, match="meta_id"):
        enrich.classified_join(frame(CLASSIFIED, C), numbers)
    with pytest.raises(ValueError, match="lacks key"):
        enrich.classified_join(frame(CLASSIFIED, C).drop("day"), frame(METADATA, M))


KEY = "meta_id string, year int, month int, date int"


def test_enriched_view(frame):
    metadata = frame([("a", 2024, 1, 1, "x"), ("b", 2024, 1, 1, "y")], f"{KEY}, country string")
    files = frame([("a", 2024, 1, 1, "f1", "one.mp3"), ("q", 2024, 1, 1, "f2", "two.mp3")],
                  f"{KEY}, id string, filename string")
    transcripts = frame([("t1", "f1", "text")], "id string, audio_file_id string, transcript_text string")
    comments = frame([("a", 2024, 1, 1)] * 3, KEY)
    subtitles = frame([("b", 2024, 1, 1)], KEY)
    out = enrich.enriched_view(metadata, files, transcripts, comments, subtitles)
    assert rows(out, "meta_id", "filename", "transcript_text", "country", "comment_count", "subtitle_count",
                "audio_file_processed", "transcript_processed") == [
        ("a", "one.mp3", "text", "x", 3, 0, True, True),
        ("b", None, None, "y", 0, 1, False, False),
    ]
    older = enrich.files_with_metadata(files, transcripts, metadata)
    assert rows(older, "id", "filename", "transcript_text", "country") == [
        ("f1", "one.mp3", "text", "x"), ("f2", "two.mp3", None, None),
    ]


def test_view_shuffles_the_wide_side_once(spark, frame, folder):
    metadata = frame([("a", 2024, 1, 1, "x")], f"{KEY}, country string")
    files = frame([("a", 2024, 1, 1, "f1")], f"{KEY}, id string")
    transcripts = frame([("t1", "f1")], "id string, audio_file_id string")
    none = frame([], KEY)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = enrich.enriched_view(metadata, files, transcripts, none, none)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # metadata, two counts, transcripts, and files by id and then by key
    assert text.count("Exchange hashpartitioning") == 6


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir() is not None
