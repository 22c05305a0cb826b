import numpy as np
import pandas as pd
import pytest

from dayfold.model import KINDS
from dayfold.sources import drops
from conftest import rows


def save(folder, name, **columns):
    pd.DataFrame(columns).to_parquet(f"{folder}/{name}")


@pytest.fixture
def drifting(folder):
    """Whole and floating numbers, an extra column, an all-null column, broken and undated files."""
    save(folder, "0_2025-01-01_00_00_metadata.parquet", meta_id=["a", "b"], flag=[1, 0], n=[1, 2])
    save(folder, "0_2025-01-01_00_10_metadata.parquet", meta_id=["a", "c"], flag=[np.nan, 1.0], extra=["e", "f"])
    save(folder, "0_2025-01-02_00_00_metadata.parquet", meta_id=["a"], flag=[1], n=[3], extra=[None])
    save(folder, "undated_metadata.parquet", meta_id=["z"], flag=[1])
    save(folder, "0_2025-01-01_00_00_comments.parquet", meta_id=["q"])
    with open(f"{folder}/0_2025-01-03_00_00_metadata.parquet", "wb") as f:
        f.write(b"not parquet")
    return folder


EXPECTED = [
    ("a", None, None, "e"), ("a", 1.0, 1, None), ("a", 1.0, 3, None), ("b", 0.0, 2, None),
    ("c", 1.0, None, "f"), ("z", 1.0, None, None),
]


@pytest.mark.parametrize("files_per_read", [20_000, 1])
def test_scan_keeps_every_readable_row(spark, drifting, files_per_read, monkeypatch):
    monkeypatch.setattr(drops, "FILES_PER_READ", files_per_read)
    df, bad = drops.scan_kind(spark, drifting, "metadata")
    assert dict(df.dtypes)["flag"] == "double"
    got = rows(df, "meta_id", "flag", "n", "extra")
    assert got == sorted(EXPECTED, key=repr)
    assert [r["path"].rsplit("/", 1)[1] for r in bad.collect()] == ["0_2025-01-03_00_00_metadata.parquet"]


def test_scan_matches_pandas_concat(spark, drifting):
    names = ["0_2025-01-01_00_00", "0_2025-01-01_00_10", "0_2025-01-02_00_00"]
    joined = pd.concat([pd.read_parquet(f"{drifting}/{n}_metadata.parquet") for n in names])
    df, _ = drops.scan_kind(spark, drifting, "metadata")
    ours = df.filter("source_filename like '0_%'").toPandas()
    assert sorted(ours["flag"].fillna(-1)) == sorted(joined["flag"].fillna(-1))
    assert str(joined["flag"].dtype) == str(ours["flag"].dtype) == "float64"


def test_row_order_columns(spark, drifting):
    df, _ = drops.scan_kind(spark, drifting, "metadata")
    first = df.filter("source_filename = '0_2025-01-01_00_00_metadata.parquet'")
    assert rows(first, "meta_id", "row_index") == [("a", 0), ("b", 1)]
    assert all(p[0].startswith("file:") for p in rows(df, "source_path"))


def test_scan_without_drift_reads_the_folder(spark, folder):
    save(folder, "0_2025-01-01_00_00_metadata.parquet", meta_id=["a"])
    save(folder, "0_2025-01-01_00_10_metadata.parquet", meta_id=["b"], more=[1])
    save(folder, "0_2025-01-01_00_10_comments.parquet", meta_id=[5])
    df, bad = drops.scan_kind(spark, folder, "metadata", columns=["meta_id"])
    assert rows(df, "meta_id") == [("a",), ("b",)] and bad.isEmpty()
    assert "more" not in df.columns


def test_recursive_and_day_and_strict(spark, folder):
    import os

    os.mkdir(f"{folder}/sub")
    save(folder, "0_2025-01-01_00_00_metadata.parquet", meta_id=["a"])
    save(f"{folder}/sub", "0_2025-01-02_00_00_metadata.parquet", meta_id=["b"])
    save(folder, "x_2025-01-01_metadata.parquet", meta_id=["c"])
    found = lambda **more: rows(drops.scan_kind(spark, folder, "metadata", **more)[0], "meta_id")
    assert found() == [("a",), ("c",)]
    assert found(recursive=True) == [("a",), ("b",), ("c",)]
    assert found(strict=True) == [("a",)]
    assert rows(drops.scan_day(spark, folder, "metadata", "2025-01-01")[0], "meta_id") == [("a",)]


def test_scan_kinds_chooses(spark, drifting):
    out = drops.scan_kinds(spark, drifting, ["comments"])
    assert list(out) == ["comments"] and rows(out["comments"][0], "meta_id") == [("q",)]


def test_nothing_readable(spark, folder):
    with open(f"{folder}/0_2025-01-03_00_00_metadata.parquet", "wb") as f:
        f.write(b"no")
    df, bad = drops.scan_kind(spark, folder, "metadata")
    assert df.count() == 0 and bad.count() == 1


def test_case_clash_is_refused(spark, folder):
    save(folder, "0_2025-01-01_00_00_metadata.parquet", meta_id=["a"], Meta_id=["b"])
    with pytest.raises(ValueError, match="case"):
        drops.scan_kind(spark, folder, "metadata")


def test_dates_and_undated(spark, drifting):
    df, _ = drops.scan_kind(spark, drifting, "metadata")
    dated = drops.with_file_date(df)
    assert rows(dated.distinct(), "year", "month", "date").count((2025, 1, 2)) == 1
    assert dated.filter("meta_id = 'z'").isEmpty()
    fine, refused = drops.sort_out(df, KINDS["metadata"])
    assert rows(refused, "reason", "rows") == [("undated", 1)] and fine.count() == 5
    assert '"meta_id":"z"' in refused.first()["detail"]


def test_prepare_keeps_last_in_file_order(spark, drifting):
    df, _ = drops.scan_kind(spark, drifting, "metadata")
    kind = KINDS["metadata"]
    batch = drops.prepare(df.withColumnRenamed("flag", "meta_secret"), kind)
    assert batch.columns == ["meta_id", "year", "month", "date", "meta_secret"]
    # the later slot has a null flag for "a": it wins, and null is false
    assert rows(batch) == [
        ("a", 2025, 1, 1, False), ("a", 2025, 1, 2, True), ("b", 2025, 1, 1, False), ("c", 2025, 1, 1, True),
    ]


def test_canonical_renames_and_casts(spark, frame):
    df = frame([("m", 2024, 1, 1, "c", "hi", 3.0, "12.345", 1, 9)],
               "meta_id string, year int, month int, date int, cid string, text string, digg_count double, "
               "reply_score string, author_pin int, junk int")
    out = drops.canonical(df, KINDS["comments"])
    assert out.columns == ["meta_id", "year", "month", "date", "cid", "comment_text", "digg_count",
                           "author_pin", "reply_score"]
    row = out.first()
    assert row["comment_text"] == "hi" and row["digg_count"] == 3 and row["author_pin"] is True
    assert str(row["reply_score"]) == "12.35"


def test_common_type():
    assert drops.common_type(["bigint", "double"]) == "double"
    assert drops.common_type(["int", "bigint", "null"]) == "bigint"
    assert drops.common_type(["null"]) == "string"
    assert drops.common_type(["string", "bigint"]) == "string"


def test_column_lists(spark):
    assert [len(KINDS[k].schema) for k in ("metadata", "comments", "subtitles")] == [106, 61, 10]
    assert [len(KINDS[k].table_schema) for k in ("metadata", "comments", "subtitles")] == [110, 65, 13]
    assert [len(KINDS[k].flags) for k in ("metadata", "comments", "subtitles")] == [12, 7, 0]
    for kind in KINDS.values():
        assert set(kind.defaults) <= set(kind.table_schema.fieldNames())
        assert set(kind.key) <= set(kind.schema.fieldNames())


def test_verify_finds_broken_pages(spark, folder):
    import numpy as np

    good, broken = f"{folder}/0_2025-01-01_00_00_metadata.parquet", f"{folder}/0_2025-01-01_00_10_metadata.parquet"
    for path in (good, broken):
        pd.DataFrame({"meta_id": [str(i) for i in np.arange(5000)]}).to_parquet(path)
    data = bytearray(open(broken, "rb").read())
    data[4:2000] = b"\xff" * 1996
    with open(broken, "wb") as f:
        f.write(data)
    df, bad = drops.scan_kind(spark, folder, "metadata", verify=True)
    assert df.count() == 5000 and [r["path"][-18:] for r in bad.collect()] == [broken[-18:]]
    unseen, none = drops.scan_kind(spark, folder, "metadata")
    assert none.isEmpty()
    with pytest.raises(Exception):
        unseen.select("meta_id").collect()


def test_ids_keep_their_digits_in_every_mix_of_types(spark, folder):
    big = [7345678901234567891, 7345678901234567893]
    save(folder, "0_2025-01-01_00_00_metadata.parquet", meta_id=big)
    save(folder, "0_2025-01-01_00_10_metadata.parquet", meta_id=[12.0, np.nan])
    save(folder, "0_2025-01-01_00_20_metadata.parquet", meta_id=["x7", str(big[0])])
    save(folder, "0_2025-01-01_00_30_metadata.parquet", meta_id=[float(big[0]), 1.5])
    df, _ = drops.scan_kind(spark, folder, "metadata")
    assert dict(df.dtypes)["meta_id"] == "string"
    assert rows(df, "meta_id") == [
        ("1.5",), ("12",), ("7345678901234567891",), ("7345678901234567891",), ("7345678901234567893",), ("x7",), (None,), (None,),
    ]
    fine, refused = drops.sort_out(df, KINDS["metadata"])
    assert rows(refused, "reason", "row_index") == [("does not fit: meta_id", 0), ("null key", 1)]
    assert drops.prepare(df, KINDS["metadata"]).count() == 5


def test_values_that_do_not_fit_are_refused(spark, folder):
    save(folder, "0_2025-01-01_00_00_comments.parquet", meta_id=["a", "b", "c", "d"], cid=["1", "2", "3", "4"],
         collection_timestamp=["notnum", "17", " ", None], reply_score=[1.0, 1000.0, 2.345, np.nan], digg_count=[1.0, 2.0, 2.5, 3.0])
    df, _ = drops.scan_kind(spark, folder, "comments")
    fine, refused = drops.sort_out(df, KINDS["comments"])
    assert rows(refused, "reason") == [
        ("does not fit: collection_timestamp",), ("does not fit: digg_count",), ("does not fit: reply_score",)]
    batch = drops.prepare(df, KINDS["comments"]).first()
    assert (batch["cid"], batch["collection_timestamp"], batch["reply_score"], batch["digg_count"]) == ("4", None, None, 3)


def test_no_files_give_an_empty_frame_with_the_stored_columns(spark, folder):
    save(folder, "0_2025-01-01_00_00_comments.parquet", meta_id=["a"])
    df, bad = drops.scan_kind(spark, folder, "metadata")
    assert df.isEmpty() and bad.isEmpty() and {"meta_id", "country", "misfits"} <= set(df.columns)


def test_partitions_follow_the_size_of_the_input(spark):
    from dayfold.session import partitions_for

    assert partitions_for(0) == 1 and partitions_for(10**6, 8) == 8
    assert partitions_for(10**12) == 7451 and partitions_for(10**18) == 200_000
