"""The media run of days: files, transcripts and status stored step by step, resumable.

A ledger has a row for every day and step that is done. A run works on all days at once, one job per
table and step, and leaves out the days whose step the ledger has: a run that was killed is taken up
at the first unfinished step of each day. Steps replace what is stored of a day, so a step that was
killed half-way is simply done again, and readers trust only the days that the ledger names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..model import DAY
from ..operators.keyed import pending
from ..operators.queue import NO_ARCHIVES, fold_status
from ..operators.reports import error_text, final_status
from ..session import work_path
from ..sources.results import read_table, replace_days
from .media import file_rows, recorded, transcript_rows

_DAYS = [T.StructField(c, T.IntegerType()) for c in DAY]
LEDGER = T.StructType([
    T.StructField("step", T.StringType()), T.StructField("run", T.StringType()), T.StructField("at", T.TimestampNTZType()), *_DAYS])
EVENTS = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.IntegerType()),
    T.StructField("transfer_task_id", T.StringType()), T.StructField("job_id", T.LongType()),
    T.StructField("error_message", T.StringType()), *_DAYS, T.StructField("run", T.StringType())])

Step = tuple[str, Callable[[DataFrame], None]]


def open_days(days: DataFrame, ledger: DataFrame, step: str) -> DataFrame:
    """Days for which the ledger does not have a step."""
    return pending(days.select(*DAY).distinct(), ledger.filter(F.col("step") == step).select(*DAY).distinct(), DAY)


def run_steps(spark: SparkSession, days: DataFrame, steps: Sequence[Step], root: str, run: str, now) -> list[str]:
    """Do the steps that days still lack, in order; the names of those that had anything to do.

    The days of a step are written before it starts, so what is done and what the ledger gets are
    the same days, whatever arrives meanwhile.
    """
    worked = []
    for name, step in steps:
        path = work_path(spark, "days")
        open_days(days, read_table(spark, f"{root}/ledger", LEDGER), name).write.parquet(path)
        left = spark.read.schema(days.select(*DAY).schema).parquet(path)
        if left.isEmpty():
            continue
        step(left)
        rows = left.select(F.lit(name).alias("step"), F.lit(run).alias("run"), F.lit(now).cast("timestamp_ntz").alias("at"), *DAY)
        rows.hint("rebalance").write.mode("append").parquet(f"{root}/ledger")
        worked.append(name)
    return worked


def outcome_of_days(days: DataFrame, members: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Counts, final status and error text of every day; a day without members has failed.

    A member without an outcome counts as failed. Members are matched by archive and file name.
    """
    told = outcomes.select("archive", "filename", F.col("error").isNull().alias("good"))
    counts = members.join(told, ["archive", "filename"], "left").groupBy(*DAY).agg(
        F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("processed_count"),
        F.sum(F.when(F.col("good"), 0).otherwise(1)).alias("failed_count"))
    joined = days.join(counts, DAY, "left")
    none = F.col("processed_count").isNull()
    return joined.withColumns({
        "status": F.when(none, "processing_failed").otherwise(final_status("processed_count", "failed_count")),
        "error_message": F.when(none, NO_ARCHIVES).otherwise(error_text("processed_count", "failed_count")),
    })


def media_steps(members: DataFrame, outcomes: DataFrame, root: str, run: str, now) -> list[Step]:
    """Steps of a media run: queue event, audio files, transcripts, final queue event.

    ``members`` are file rows of archives, ``outcomes`` what became of them.
    """
    at = F.lit(now).cast("timestamp_ntz")

    def event(days: DataFrame, seq: int, status, error) -> None:
        rows = days.select(
            status.alias("status"), at.alias("ts"), F.lit(seq).alias("seq"), F.lit(None).cast("string").alias("transfer_task_id"),
            F.lit(None).cast("long").alias("job_id"), error.alias("error_message"),
            F.concat(F.lit(f"{run}-"), F.lit(seq).cast("string")).alias("run"), *DAY)
        replace_days(rows, f"{root}/status_events", [*DAY, "run"])

    def of(days: DataFrame) -> DataFrame:
        return members.join(days, DAY, "left_semi")

    def started(days: DataFrame) -> None:
        event(days, 0, F.lit("processing"), F.lit(None).cast("string"))

    def files(days: DataFrame) -> None:
        replace_days(file_rows(recorded(of(days), outcomes)), f"{root}/audio_files")

    def transcripts(days: DataFrame) -> None:
        done = recorded(of(days), outcomes)
        rows = transcript_rows(done).join(done.select(F.col("id").alias("audio_file_id"), *DAY), "audio_file_id")
        replace_days(rows, f"{root}/transcripts")

    def finished(days: DataFrame) -> None:
        event(outcome_of_days(days, of(days), outcomes), 1, F.col("status"), F.col("error_message"))

    return [("started", started), ("audio_files", files), ("transcripts", transcripts), ("finished", finished)]


def media_run(spark: SparkSession, days: DataFrame, members: DataFrame, outcomes: DataFrame, root: str, run: str, now) -> list[str]:
    """Run the media steps of all days; the names of the steps that had anything to do."""
    return run_steps(spark, days, media_steps(members, outcomes, root, run, now), root, run, now)


def queue_of(spark: SparkSession, root: str) -> DataFrame:
    """The queue as the stored status events tell it."""
    return fold_status(read_table(spark, f"{root}/status_events", EVENTS))


def finished_rows(spark: SparkSession, root: str, name: str, step: str) -> DataFrame:
    """Stored rows of the days whose step is done."""
    done = read_table(spark, f"{root}/ledger", LEDGER).filter(F.col("step") == step).select(*DAY).distinct()
    return spark.read.parquet(f"{root}/{name}").join(done, DAY, "left_semi")
