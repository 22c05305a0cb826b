import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from dayfold import functions as f


def one(spark, expression, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(expression.alias("x")).first()["x"]


def column(frame, values, kind, expression):
    return [r["x"] for r in frame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
            .orderBy("i").select(expression.alias("x")).collect()]


def test_file_dates(frame):
    names = ["0_2025-01-31_00_00_subtitles.parquet", "x2024-02-30y2023-01-01", "nothing", "2024-1-1", None]
    assert column(frame, names, "string", f.file_year("v")) == [2025, 2024, None, None, None]
    assert column(frame, names, "string", f.file_month("v")) == [1, 2, None, None, None]
    assert column(frame, names, "string", f.file_day("v")) == [31, 30, None, None, None]
    assert column(frame, names, "string", f.has_file_date("v")) == [True, True, False, False, None]


def test_slot_of_archive(frame):
    names = ["0_2025-01-31_23_50.tar.xz", "0_2025-01-31_23_50.tar", "a/0_2025-01-31_00_10.tar.xz"]
    assert column(frame, names, "string", f.slot_of_archive("v")) == ["23_50", None, "00_10"]


def test_day_text_and_guard(spark, frame):
    assert one(spark, f.day_text("y", "m", "d"), y=2025, m=1, d=5) == "2025-01-05"
    assert one(spark, f.day_text("y", F.lit(None), "d"), y=2025, d=5) is None
    texts = ["2025-01-05", "2025-1-5", "x2025-01-05", "2025-99-99"]
    assert column(frame, texts, "string", f.is_day_text("v")) == [True, False, False, True]


def test_month_number(frame):
    texts = ["January", "SEPT", "sep", "7", "13", "0", "mai", "may", "+5", None, "december"]
    assert column(frame, texts, "string", f.month_number("v")) == [1, 9, 9, 7, None, None, None, 5, 5, None, 12]


def test_ranges(frame):
    assert column(frame, [1999, 2000, 2030, 2031], "int", f.in_year_range("v")) == [False, True, True, False]
    assert column(frame, [0, 1, 31, 32], "int", f.in_day_range("v")) == [False, True, True, False]


def test_folder_round_trip(spark, frame):
    assert one(spark, f.folder_name("l", "y", "m"), l="zurich", y=2025, m=2) == "zurich_2025_february"
    names = ["zurich_2025_february", "Zurich_2025_february", "zurich_2025_feb", "zurich_25_may", "a_2025_dec_1"]
    out = column(frame, names, "string", f.parse_folder("v"))
    assert tuple(out[0]) == ("zurich", 2025, 2, "2025-02-01", None)
    assert [r["error"] for r in out] == [None, "shape", "month", "shape", "shape"]


def test_paths(spark):
    assert one(spark, f.storage_path("y", "m", "d", "s", "n"), y=2025, m=1, d=2, s="23_50", n="a.opus") == \
        "audio/2025/01/02/23_50/a.opus"
    assert one(spark, f.extension_swapped("a", "m"), a="x/day.tar.gz", m="d/one.mp3") == "day/one.opus"
    assert one(spark, f.file_stem("m"), m="d/one.two.mp3") == "one.two"
    assert one(spark, f.archive_stem("m"), m="d/0_2025-01-31_23_50.tar.xz") == "0_2025-01-31_23_50"


TEXTS = ["a", " ", "\t\n", " ", "\x1c", "\x85", "​", "", "  x ", None]


def test_nonblank_and_strip_match_python(frame):
    assert column(frame, TEXTS, "string", f.nonblank("v")) == [bool(t and t.strip()) for t in TEXTS]
    assert column(frame, TEXTS, "string", f.strip("v")) == [None if t is None else t.strip() for t in TEXTS]


def test_template_is_literal(spark):
    text = "costs $1 and \\0 {content_text}"
    assert one(spark, f.fill_template("A {content_text} B", "t"), t=text) == f"A {text} B"


def test_split(frame):
    assert column(frame, ["Été, der_Tag 42! don't"], "string", f.split_words("v")) == \
        [["été", "der_tag", "42", "don", "t"]]


def test_every_space_is_stripped(frame):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    assert column(frame, [c + "x" + c for c in spaces], "string", f.strip("v")) == ["x"] * len(spaces)
    assert column(frame, spaces, "string", f.nonblank("v")) == [False] * len(spaces)


def test_flags_match_pandas(frame):
    import pandas as pd

    values = [0.0, 1.0, None, math.nan, 0.5, 2.0, -1.0, -0.5]
    expected = pd.Series(values, dtype="float64").fillna(0).astype(int).astype(bool).tolist()
    assert column(frame, values, "double", f.flag("v")) == expected
    assert column(frame, [True, False, None], "boolean", f.flag("v")) == [True, False, False]
    assert column(frame, [1, 0, None], "bigint", f.flag("v")) == [True, False, False]


@pytest.mark.parametrize("seconds", [0, 59.25, 3600, 86400, 97200.5, 200000, 864000, -5])
def test_elapsed(frame, seconds):
    start = dt.datetime(2025, 3, 29, 22)
    gap = dt.timedelta(seconds=seconds)
    df = frame([(start, start + gap)], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(f.elapsed_text("a", "b").alias("t"), f.elapsed_seconds("a", "b").alias("s")).first()
    assert row["t"] == str(gap) and row["s"] == seconds


def test_elapsed_of_null(frame):
    df = frame([(None, dt.datetime(2025, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(f.elapsed_text("a", "b").alias("t")).first()["t"] is None


def test_scores(spark):
    df = spark.sql("select array(1000.0D, 1001.0D, 999.0D) as s")
    row = df.select(f.softmax("s").alias("p"), f.argmax_index("s").alias("i")).first()
    assert row["i"] == 1 and abs(sum(row["p"]) - 1) < 1e-12
    assert abs(row["p"][1] - 1 / (1 + math.exp(-1) + math.exp(-2))) < 1e-12


def test_label_of_token(frame):
    assert column(frame, ["1", "0", " 1", "x", None], "string", f.label_of_token("v")) == [1, 0, 0, 0, 0]


def test_small_ones(spark):
    assert one(spark, f.seconds_of_samples("n"), n=24000) == 1.5
    assert one(spark, f.zero_if_null(F.lit(None).cast("int"))) == 0
    assert one(spark, f.surrogate_id("a", "b"), a="x", b=1) == one(spark, f.surrogate_id("a", "b"), a="x", b=1)
