"""Counts, outcomes and statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_text, is_blank, seconds_of_samples, strip, zero_if_null
from ..model import (
    ARRIVED_PERCENT, DAY, WORKER_COMPLETED, WORKER_FAILED, WORKER_RUNNING,
)


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def status_summary(queue: DataFrame) -> DataFrame:
    """Rows, oldest and newest day of each status.

    Days are compared as numbers, which a hash aggregate can hold, and shown as text.
    """
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("date")

    def text(n: Column) -> Column:
        return day_text(F.floor(n / 10000), F.floor(n / 100) % 100, n % 100)

    return queue.groupBy("status").agg(
        F.count("*").alias("count"), F.min(number).alias("low"), F.max(number).alias("high")
    ).select("status", "count", text(F.col("low")).alias("oldest"), text(F.col("high")).alias("newest"))


def class_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent, to one decimal, of class 0 and of class 1 among all rows."""
    counted = df.agg(
        F.count("*").alias("total"),
        _count_if(F.col(column) == 0).alias("n0"),
        _count_if(F.col(column) == 1).alias("n1"),
    )
    rows = counted.select("total", F.explode(F.array(
        F.struct(F.lit(0).alias("classification"), F.col("n0").alias("count")),
        F.struct(F.lit(1).alias("classification"), F.col("n1").alias("count")),
    )).alias("r"))
    percent = F.round(F.lit(100.0) * F.col("r.count") / F.nullif(F.col("total"), F.lit(0)), 1)
    return rows.select("r.classification", "r.count", percent.alias("percent"))


def day_statistics(
    files: DataFrame, transcripts: DataFrame, metadata: DataFrame, queue: DataFrame
) -> DataFrame:
    """Numbers of files, transcripts and metadata rows, and the queue row, of every day.

    The sides are counted per day before they meet. Days that only some sides know are kept,
    with 0 or ``not_found`` for the rest.
    """
    sides = [
        files.groupBy(*DAY).agg(F.count("*").alias("audio_files")),
        transcripts.groupBy(*DAY).agg(F.count("*").alias("transcripts")),
        metadata.groupBy(*DAY).agg(F.count("*").alias("metadata_records")),
        queue.select(
            *DAY, F.col("status").alias("queue_status"), "processing_start", "processing_end",
            "error_message", F.lit(True).alias("queued"),
        ),
    ]
    joined = reduce(lambda a, b: a.join(b, DAY, "full_outer"), sides)
    return joined.select(
        day_text(*DAY).alias("date"),
        *[zero_if_null(c).alias(c) for c in ("audio_files", "transcripts", "metadata_records")],
        F.when(F.col("queued"), F.col("queue_status")).otherwise("not_found").alias("queue_status"),
        "processing_start", "processing_end", "error_message",
    )


def worker_rollup(workers: DataFrame, master: str = "master_job_id", state: str = "state") -> DataFrame:
    """Completed, failed, running and finished workers of each master job; other states count nowhere."""
    s = F.col(state)
    return workers.groupBy(master).agg(
        F.count("*").alias("workers"),
        _count_if(s.isin(WORKER_COMPLETED)).alias("completed"),
        _count_if(s.isin(WORKER_FAILED)).alias("failed"),
        _count_if(s.isin(WORKER_RUNNING)).alias("running"),
    ).withColumn("finished", F.col("completed") + F.col("failed"))


def master_progress(tracking: DataFrame) -> DataFrame:
    """Files processed and failed over all archives of a master job."""
    return tracking.groupBy("master_job_id").agg(
        F.count("*").alias("archives"),
        F.coalesce(F.sum("files_processed"), F.lit(0)).cast("long").alias("files_processed"),
        F.coalesce(F.sum("files_failed"), F.lit(0)).cast("long").alias("files_failed"),
    )


def archive_outcomes(members: DataFrame, archive: str, ok: Column) -> DataFrame:
    """Members, successes and failures of each archive; one failure makes it ``failed``."""
    good = F.coalesce(ok, F.lit(False))
    return members.groupBy(archive).agg(
        F.count("*").alias("total"),
        _count_if(good).alias("succeeded"),
        _count_if(~good).alias("failed"),
    ).withColumn("archive_failed", F.col("failed") > 0)


def archive_totals(outcomes: DataFrame) -> DataFrame:
    """Grand totals over archives."""
    return outcomes.agg(
        _count_if(~F.col("archive_failed")).alias("archives_processed"),
        _count_if(F.col("archive_failed")).alias("archives_failed"),
        F.coalesce(F.sum("succeeded"), F.lit(0)).alias("files_converted"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("files_failed"),
    )


def batch_outcome(df: DataFrame, by: Sequence[str], ok: Column) -> DataFrame:
    """Processed and failed rows of each group."""
    good = F.coalesce(ok, F.lit(False))
    return df.groupBy(*by).agg(
        _count_if(good).alias("processed_count"), _count_if(~good).alias("failed_count")
    )


def final_status(processed: str | Column, failed: str | Column) -> Column:
    p = F.col(processed) if isinstance(processed, str) else processed
    f = F.col(failed) if isinstance(failed, str) else failed
    return (
        F.when(f == 0, "completed")
        .when((f > 0) & (p > 0), "completed_with_errors")
        .otherwise("processing_failed")
    )


def error_text(processed: str | Column, failed: str | Column) -> Column:
    p = F.col(processed) if isinstance(processed, str) else processed
    f = F.col(failed) if isinstance(failed, str) else failed
    return F.when(f > 0, F.concat(
        F.lit("Failed files: "), f.cast("string"), F.lit(", Processed: "), p.cast("string")
    ))


def with_final_status(outcome: DataFrame) -> DataFrame:
    return outcome.withColumns({
        "status": final_status("processed_count", "failed_count"),
        "error_message": error_text("processed_count", "failed_count"),
    })


def rows_per_file(df: DataFrame, name: str = "source_filename") -> DataFrame:
    return df.groupBy(name).agg(F.count("*").alias("rows"))


def completeness_gate(expected: DataFrame, arrived: DataFrame, percent: int = ARRIVED_PERCENT) -> DataFrame:
    """Whether enough files of each expected day arrived.

    ``expected`` has a day and ``expected``, ``arrived`` one row per file.
    """
    counts = arrived.groupBy(*DAY).agg(F.count("*").alias("arrived"))
    needed = F.floor(F.col("expected") * percent / 100).cast("long")
    return (
        expected.join(counts, DAY, "left")
        .withColumn("arrived", zero_if_null("arrived"))
        .withColumn("needed", needed)
        .withColumn(
            "status",
            F.when(F.col("arrived") >= F.col("needed"), "ready_to_process").otherwise("transfer_failed"),
        )
    )


SEGMENTS_PER_PIECE = 1024


def assemble_transcripts(
    segments: DataFrame,
    key: Sequence[str],
    ordinal: str,
    text: str,
    samples: str | None = None,
) -> DataFrame:
    """One text per key: stripped segments in order with one space between, with its word count.

    A key's text is one value, but its segments are not gathered at once: runs of
    ``SEGMENTS_PER_PIECE`` ordinals become pieces in separate groups, and only the pieces are
    put together. Words are counted on the segments. ``samples`` adds the length in seconds.
    """
    keys = list(key)
    clean = F.coalesce(strip(text), F.lit(""))
    n_words = F.size(F.filter(F.split(clean, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""))
    pieces = segments.select(
        *keys,
        F.col(ordinal).alias("__at"),
        F.floor(F.col(ordinal) / SEGMENTS_PER_PIECE).alias("__piece"),
        clean.alias("__text"),
        n_words.alias("__words"),
        *([F.col(samples).alias("__samples")] if samples else []),
    ).groupBy(*keys, "__piece").agg(
        F.array_sort(F.collect_list(F.struct("__at", "__text"))).alias("__parts"),
        F.sum("__words").alias("__words"),
        F.count("*").alias("__n"),
        *([F.sum("__samples").alias("__samples")] if samples else []),
    ).withColumn("__text", F.array_join(F.col("__parts.__text"), " ")).drop("__parts")
    whole = pieces.groupBy(*keys).agg(
        F.array_join(
            F.array_sort(F.collect_list(F.struct("__piece", "__text")))["__text"], " "
        ).alias("transcript_text"),
        F.sum("__words").cast("long").alias("word_count"),
        F.sum("__n").cast("long").alias("segments"),
        *([seconds_of_samples(F.sum("__samples")).alias("duration_seconds")] if samples else []),
    )
    return whole


def transcripts_of(files: DataFrame, assembled: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every file with its text; a file without segments has the empty text."""
    return files.join(assembled, list(key), "left").withColumns({
        "transcript_text": F.coalesce("transcript_text", F.lit("")),
        "word_count": zero_if_null("word_count").cast("long"),
    })


def ordered_labels(df: DataFrame, by: Sequence[str], label: str, order: str, name: str = "labels") -> DataFrame:
    """Distinct labels of each group in the order of their rank, as one text.

    Labels are made distinct before they are gathered, so a group holds as many entries as
    there are labels, not rows.
    """
    ranked = df.groupBy(*by, label).agg(F.min(order).alias("__at"))
    return ranked.groupBy(*by).agg(
        F.array_join(
            F.array_sort(F.collect_list(F.struct("__at", label)))[label], ", "
        ).alias(name)
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_text(df: DataFrame, text: str) -> DataFrame:
    """Rows in all, rows without text, and rows whose text is blank."""
    return df.agg(
        F.count("*").alias("total"),
        _count_if(F.col(text).isNull()).alias("missing"),
        _count_if(is_blank(text)).alias("blank"),
    )


def latest_version(versions: DataFrame) -> DataFrame:
    """The highest version text and the one applied last."""
    return versions.agg(
        F.max("version").alias("max_version"),
        F.max_by("version", F.struct("applied_at", "version")).alias("last_version"),
    )

