"""Joins of classified text, metadata, media files, transcripts and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import zero_if_null
from ..model import BUSINESS_KEY, DAY
from .skew import HOT_ROWS, salted_inner_join


def child_counts(children: DataFrame, name: str, key: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """Rows per business key, combined before the shuffle."""
    return children.groupBy(*key).agg(F.count("*").alias(name))


def check_key_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Refuse keys of different kinds, which Spark would cast without a word."""
    kinds = {"string": "text", "varchar": "text", "boolean": "boolean"}
    for key in keys:
        a, b = (kinds.get(dict(d.dtypes)[key], "number") for d in (left, right))
        if a != b:
            raise TypeError(f"key {key} is {a} on the left and {b} on the right")


def classified_join(
    classified: DataFrame,
    metadata: DataFrame,
    on: Sequence[str] = ("meta_id", "year", "month", "day"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Classified rows with the metadata of the same id and day; every match is kept.

    Null ids match null ids; null days match nothing. Other columns that both sides have get
    ``_x`` and ``_y``. Columns come left then right. All days join at once. Keep the file name and
    row number that a scan gives: they tell copies of one row apart when a hot id is spread.
    """
    keys = list(on)
    for side, df in (("classified", classified), ("metadata", metadata)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"{side} data lacks key columns {missing}")
    check_key_types(classified, metadata, keys)
    clash = {c for c in classified.columns if c in metadata.columns and c not in keys}
    left = classified.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = metadata.withColumnsRenamed({c: f"{c}_y" for c in clash})
    return salted_inner_join(left, right, keys, keys[:1], hot_rows=hot_rows)


# Columns that the views show, in order.
VIEW_METADATA = [
    "author_nickname", "author_uniqueid", "music_title", "stats_playcount", "stats_diggcount",
    "stats_commentcount", "video_duration", "country", "poi_name", "poi_city", "meta_desc",
]
VIEW_FILES = [
    "filename", "file_path", "file_size_bytes", "location", "classification",
    "classification_probability",
]
VIEW_TRANSCRIPTS = ["transcript_text", "word_count", "duration_seconds"]


def files_with_transcripts(files: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Files left-joined to their transcript, as ``audio_file_id`` and ``transcript_id``."""
    named = transcripts.select(
        F.col("audio_file_id"), F.col("id").alias("transcript_id"),
        *[c for c in VIEW_TRANSCRIPTS if c in transcripts.columns],
    )
    heads = files.select(
        *BUSINESS_KEY, F.col("id").alias("audio_file_id"),
        *[c for c in VIEW_FILES if c in files.columns],
        *([F.col("created_at").alias("audio_file_created_at")] if "created_at" in files.columns else []),
    )
    return heads.join(named, "audio_file_id", "left")


def enriched_view(
    metadata: DataFrame,
    files: DataFrame,
    transcripts: DataFrame,
    comments: DataFrame,
    subtitles: DataFrame,
) -> DataFrame:
    """Metadata with its file, transcript, numbers of comments and subtitles, and presence flags.

    Transcripts meet the narrow files first, so the wide metadata side is shuffled once, by the
    business key that the counts are already partitioned by.
    """
    media = files_with_transcripts(files, transcripts)
    joined = (
        metadata.join(media, BUSINESS_KEY, "left")
        .join(child_counts(comments, "comment_count"), BUSINESS_KEY, "left")
        .join(child_counts(subtitles, "subtitle_count"), BUSINESS_KEY, "left")
    )
    created = (
        [F.col("created_at").alias("metadata_created_at")] if "created_at" in metadata.columns else []
    )
    return joined.select(
        *BUSINESS_KEY,
        "audio_file_id",
        *[c for c in VIEW_FILES if c in media.columns],
        *[c for c in VIEW_TRANSCRIPTS if c in media.columns],
        *[c for c in VIEW_METADATA if c in metadata.columns],
        zero_if_null("comment_count").alias("comment_count"),
        zero_if_null("subtitle_count").alias("subtitle_count"),
        F.col("audio_file_id").isNotNull().alias("audio_file_processed"),
        F.col("transcript_id").isNotNull().alias("transcript_processed"),
        *created,
        *(["audio_file_created_at"] if "audio_file_created_at" in media.columns else []),
    )


def files_with_metadata(files: DataFrame, transcripts: DataFrame, metadata: DataFrame) -> DataFrame:
    """The older view: every file with its transcript and metadata, without counts."""
    media = files_with_transcripts(files, transcripts).drop("transcript_id")
    facts = metadata.select(*BUSINESS_KEY, *[c for c in VIEW_METADATA if c in metadata.columns])
    return media.join(facts, BUSINESS_KEY, "left").withColumnRenamed("audio_file_id", "id")


def day_transcripts(transcripts: DataFrame, files: DataFrame) -> DataFrame:
    """Transcripts with the day of their file; transcripts without a file are left out."""
    heads = files.select(F.col("id").alias("audio_file_id"), *DAY)
    return transcripts.join(heads, "audio_file_id", "inner")


def files_per_day(queue: DataFrame, files: DataFrame, name: str = "files_processed") -> DataFrame:
    """Queue rows with the number of files of their day, 0 when there are none."""
    counts = files.groupBy(*DAY).agg(F.count("*").alias(name))
    return queue.join(counts, DAY, "left").withColumn(name, zero_if_null(name))
