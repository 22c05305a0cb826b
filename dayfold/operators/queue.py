"""The processing queue: one row per day, its state folded from status events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..model import DAY, FINAL_STATUSES, RUNNING_STATUSES
from .keyed import insert_absent
from .ranking import first_distinct, scalar

# Fixed value: what is stored for a day without archives.
NO_ARCHIVES = "No tar.xz files found"


def _time_of(statuses: Sequence[str], at: Column) -> Column:
    return F.max(F.when(F.col("status").isin(list(statuses)), at))


def _last_value(name: str, order: Column) -> Column:
    """The latest value that is not null: an event without one keeps the old value."""
    return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), order))


def fold_status(
    events: DataFrame, day: Sequence[str] = DAY, ts: str = "ts", seq: str = "seq"
) -> DataFrame:
    """The queue row of every day from its status events, in order of time, then sequence.

    One aggregation; every part of it combines before the shuffle, so a day with many events
    sends one row per task. The same expression folds a stream.
    """
    order = F.struct(ts, seq)
    at = F.col(ts)
    return events.groupBy(*day).agg(
        F.max_by("status", order).alias("status"),
        _time_of(["transferring"], at).alias("transfer_start"),
        _time_of(["ready_to_process"], at).alias("transfer_end"),
        _time_of(["processing"], at).alias("processing_start"),
        _time_of(FINAL_STATUSES, at).alias("processing_end"),
        _last_value("transfer_task_id", order).alias("transfer_task_id"),
        _last_value("job_id", order).alias("job_id"),
        _last_value("error_message", order).alias("error_message"),
    )


def add_entries(queue: DataFrame, entries: DataFrame, order: Sequence[str]) -> DataFrame:
    """The queue plus entries for days it lacks, as ``pending``; the first entry of a day wins."""
    return insert_absent(queue, entries, DAY, order, {"status": "pending"})


def running_days(queue: DataFrame) -> DataFrame:
    return queue.filter(F.col("status").isin(RUNNING_STATUSES))


def dispatchable(queue: DataFrame, n: int, columns: Sequence[str] = (*DAY, "location")) -> DataFrame:
    """The first ``n`` days that are pending and have no running job."""
    busy = running_days(queue).select(*DAY).distinct()
    free = queue.filter(F.col("status") == "pending").join(busy, DAY, "left_anti")
    order = [*DAY, *[c for c in columns if c not in DAY]]
    return first_distinct(free, list(columns), order, n)


def of_day(queue: DataFrame, year: int, month: int, date: int) -> DataFrame:
    return queue.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("date") == date))


def location_of(queue: DataFrame, year: int, month: int, date: int, default: str) -> DataFrame:
    """One row: the day's location, or the default."""
    return scalar(of_day(queue, year, month, date), "location", default, "location")


def day_outcome(rollup: DataFrame, timed_out: Column | None = None) -> DataFrame:
    """Status and error text of a day from the numbers of its workers."""
    late = timed_out if timed_out is not None else F.lit(False)
    none, failed = F.col("workers") == 0, F.col("failed")
    status = (
        F.when(none | late, "processing_failed")
        .when(failed == 0, "completed")
        .otherwise("completed_with_errors")
    )
    error = (
        F.when(none, F.lit(NO_ARCHIVES))
        .when(late, F.lit("Worker jobs timed out"))
        .when(failed > 0, F.concat(failed.cast("string"), F.lit(" worker jobs failed")))
    )
    return rollup.withColumns({"status": status, "error_message": error})
