"""The status report: rows per status, and the latest completions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import day_text, elapsed_seconds, elapsed_text
from ..model import DAY
from ..operators.enrich import files_per_day
from ..operators.ranking import latest
from ..operators.reports import status_summary


def recent_completions(queue: DataFrame, files: DataFrame, n: int = 10) -> DataFrame:
    """The latest completed days with their duration and number of files.

    The days are chosen before files are counted, so the count meets ``n`` queue rows.
    """
    done = latest(queue.filter(F.col("status") == "completed"), "processing_end", n, DAY)
    return files_per_day(done, files, "files").select(
        day_text(*DAY).alias("date"),
        elapsed_text("processing_start", "processing_end").alias("duration"),
        elapsed_seconds("processing_start", "processing_end").alias("duration_seconds"),
        "files",
    )


def status_report(queue: DataFrame, files: DataFrame) -> dict[str, DataFrame]:
    return {"status_summary": status_summary(queue), "recent_completions": recent_completions(queue, files)}
