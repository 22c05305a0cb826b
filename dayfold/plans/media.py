"""Day media run: archives, members, transcripts and outcomes as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    base_name, extension_swapped, file_day, file_month, file_stem, file_year, slot_of_archive,
    storage_path, surrogate_id,
)
from ..model import BUSINESS_KEY
from ..operators.keyed import pending


def member_files(members: DataFrame) -> DataFrame:
    """Members of dated archives as file rows: key, slot, paths and id.

    The id of a media item is the stem of its file name.
    """
    archive = base_name("archive")
    return members.select(
        file_stem("member").alias("meta_id"),
        file_year(archive).alias("year"),
        file_month(archive).alias("month"),
        file_day(archive).alias("date"),
        slot_of_archive(archive).alias("slot"),
        base_name("member").alias("filename"),
        extension_swapped("archive", "member").alias("output_path"),
        F.col("size").alias("file_size_bytes"),
        "archive",
    )


def to_convert(members: DataFrame, outputs: DataFrame) -> DataFrame:
    """Members whose output does not exist yet; ``outputs`` has ``output_path``."""
    return pending(members, outputs, "output_path")


def recorded(
    members: DataFrame, outcomes: DataFrame, on: Sequence[str] = ("archive", "filename")
) -> DataFrame:
    """Members that have an outcome and did not fail, with id, storage path and transcript.

    Outcomes are matched by name, never by position.
    """
    joined = members.join(outcomes, list(on), "inner").filter(F.col("error").isNull())
    return joined.withColumns({
        "id": surrogate_id(*BUSINESS_KEY),
        "file_path": storage_path(
            "year", "month", "date", "slot",
            F.regexp_replace("filename", r"\.mp3$", ".opus"),
        ),
    })


def file_rows(done: DataFrame) -> DataFrame:
    return done.select("id", *BUSINESS_KEY, "filename", "file_path", "file_size_bytes")


def transcript_rows(done: DataFrame) -> DataFrame:
    """Transcripts of the recorded members that have one."""
    return done.filter(F.col("transcript_text").isNotNull()).select(
        surrogate_id(F.lit("transcript"), "id").alias("id"),
        F.col("id").alias("audio_file_id"),
        "transcript_text", "word_count", "duration_seconds",
    )


def record_batch(
    members: DataFrame, outcomes: DataFrame, path: str, on: Sequence[str] = ("archive", "filename")
) -> tuple[DataFrame, DataFrame]:
    """File rows and transcript rows of a batch, joined once and kept under ``path``."""
    recorded(members, outcomes, on).write.mode("overwrite").parquet(path)
    done = members.sparkSession.read.parquet(path)
    return file_rows(done), transcript_rows(done)
