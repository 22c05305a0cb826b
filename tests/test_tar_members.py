import io
import os
import tarfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from dayfold.sources import archives, tar_members


def archive(path, members, mode="w:xz"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with tarfile.open(path, mode) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


@pytest.fixture
def root(folder):
    archive(f"{folder}/in/a.tar.xz", [("d/one.mp3", b"11"), ("two.MP3", b"2"), ("x.txt", b"")])
    archive(f"{folder}/in/b.tar", [("three.mp3", b"333")], "w")
    archive(f"{folder}/in/deep/c.tar.gz", [("four.mp3", os.urandom(50000))], "w:gz")
    archive(f"{folder}/in/empty.tar", [], "w")
    with open(f"{folder}/in/other.zip", "wb") as f:
        f.write(b"no tar")
    return f"{folder}/in"


def load(spark, root, **options):
    tar_members.register(spark)
    return spark.read.format("tar_members").options(**options).load(root)


def test_members_and_content(spark, root, monkeypatch):
    df = load(spark, root)
    assert df.columns == ["archive", "member", "size", "error"]
    assert rows(df, "member", "size") == [("d/one.mp3", 2), ("four.mp3", 50000), ("three.mp3", 3), ("two.MP3", 1), ("x.txt", 0)]
    monkeypatch.setattr(tar_members, "BATCH_BYTES", 1)
    full = load(spark, root, content="true")
    members, _ = archives.explode_archives(archives.scan_archives(spark, root), ".mp3", content=True)
    shown = ("member", "size", F.md5("content"))
    assert rows(full.filter(F.col("member").endswith(".mp3")), *shown) == rows(members, *shown)
    assert rows(load(spark, root, recursive="false"), "member")[-1] == ("x.txt",) and load(spark, root, recursive="false").count() == 4


def test_small_archives_share_a_task(spark, root):
    assert load(spark, root).rdd.getNumPartitions() == 1
    assert load(spark, root, partitionBytes="1").rdd.getNumPartitions() == 4


def test_conditions_are_pushed_down(spark, root):
    reader = tar_members.TarMembersReader({"path": root}, ["archive", "member", "size", "error"])
    ends = tar_members.StringEndsWith(("member",), ".mp3")
    one = tar_members.In(("archive",), (f"{root}/a.tar.xz", f"{root}/none.tar"))
    assert list(reader.pushFilters([ends, one])) == [ends, one]
    parts = reader.partitions()
    assert [p.paths for p in parts] == [[f"{root}/a.tar.xz"]]
    assert [b.to_pydict()["member"] for b in reader.read(parts[0])] == [["d/one.mp3"]]
    found = load(spark, root).filter((F.col("archive") == f"{root}/b.tar") & F.col("member").endswith("mp3"))
    assert rows(found, "member") == [("three.mp3",)] and found.rdd.getNumPartitions() == 1


def test_broken_archives(spark, root):
    sound = load(spark, root).count()
    with open(f"{root}/deep/c.tar.gz", "rb") as f:
        half = f.read()[:20000]
    with open(f"{root}/z.tar.gz", "wb") as f:
        f.write(half)
    with pytest.raises(PySparkException):
        load(spark, root).collect()
    told = load(spark, root, broken="report")
    assert rows(told.filter("error IS NOT NULL"), "archive", "member") == [(f"{root}/z.tar.gz", None)]
    assert told.filter("error IS NULL").count() == sound
    assert told.filter(F.col("member").endswith(".txt")).count() == 1
    with pytest.raises(PySparkException, match="fail or report"):
        load(spark, root, broken="maybe").collect()


def test_no_archives(spark, folder):
    os.makedirs(f"{folder}/none")
    assert load(spark, f"{folder}/none", content="true").collect() == []
