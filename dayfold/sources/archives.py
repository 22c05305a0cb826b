"""Tar archives of media files, and manifests of arrived files."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import base_name
from ..session import work_path
from .drops import list_files, one_task_each, open_file

ARCHIVE_PATTERN = "*.{tar,tar.gz,tar.xz}"
BATCH_BYTES = 64 << 20


def scan_archives(
    spark: SparkSession, root: str, pattern: str = ARCHIVE_PATTERN, recursive: bool = True
) -> DataFrame:
    """Archives by path, with their length; nothing is opened."""
    return list_files(spark, root, pattern, recursive)


def explode_archives(
    archives: DataFrame, suffix: str = ".mp3", content: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Members whose name ends in ``suffix``, as it is written, and archives that failed.

    A task streams one archive after the other, ``BATCH_BYTES`` of members at a time, so archives may
    be larger than memory. Each is opened and decompressed once: members, and the error of an
    archive that breaks half-way, are written as they come, and such an archive's members are left
    out of what is read back.
    """
    columns = ["archive", "member", "size", "content", "error"]
    schema = "archive string, member string, size long, content binary, error string"

    def members(path: str) -> Iterator[tuple]:
        system, name = open_file(path)
        with system.open_input_stream(name, compression=None) as raw:
            with tarfile.open(fileobj=raw, mode="r|*") as tar:
                for info in tar:
                    if info.isfile() and info.name.endswith(suffix):
                        data = tar.extractfile(info).read() if content else None
                        yield (path, info.name, info.size, data, None)

    def frames_of(path: str) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        try:
            for row in members(path):
                rows.append(row)
                held += row[2] if content else 0
                if held > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
        except Exception as error:  # noqa: BLE001 - reported per archive
            rows = [(path, None, None, None, f"{type(error).__name__}: {error}")]
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                yield from frames_of(path)

    spark = archives.sparkSession
    path = work_path(spark, "members")
    one_task_each(archives.select("path")).mapInPandas(run, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    failed = found.filter(F.col("error").isNotNull()).select("archive", "error")
    kept = found.filter(F.col("error").isNull()).drop("error").join(failed.select("archive"), "archive", "left_anti")
    return (kept if content else kept.drop("content")), failed


def manifest(
    listings: Sequence[DataFrame], date, source_root: str = "", target_root: str = ""
) -> DataFrame:
    """Files of all listings whose name holds the date, with source and target path.

    ``date`` is a text or a column. Listings are taken whole.
    """
    day = F.lit(date) if isinstance(date, str) else date
    union = listings[0].select("name")
    for other in listings[1:]:
        union = union.unionByName(other.select("name"))
    return union.filter(F.col("name").contains(day)).select(
        "name",
        F.concat(F.lit(source_root), "name").alias("source_path"),
        F.concat(F.lit(target_root), "name").alias("destination_path"),
    )


def manifest_status(found: DataFrame) -> DataFrame:
    """One row: number of files and ``FAILED`` when there are none."""
    return found.agg(F.count("*").alias("files_found")).withColumn(
        "status", F.when(F.col("files_found") == 0, "FAILED").otherwise("READY")
    )


def names_of(files: DataFrame) -> DataFrame:
    return files.select(base_name("path").alias("name"))
