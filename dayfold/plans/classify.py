"""Classify subtitles, then join the results to metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import base_name, file_day, file_month, file_year
from ..operators.enrich import classified_join
from ..operators.quality import require_columns
from ..operators.scoring import MakeScorer, score_resumable
from ..model import KINDS
from ..sources.drops import MISFITS, REJECTS, list_files, scan_files, scan_kind, sort_out, unreadable
from ..sources.results import load_classified, write_result

ROW_KEY = ["source_filename", "row_index"]
RESULT_COLUMNS = [
    "meta_id", "row_index", "year", "month", "day", "source_filename", "content",
    "decoded_token", "classification", "prob_0", "prob_1",
]


def rejects_of(spark: SparkSession, path: str) -> DataFrame:
    """What the job that wrote ``path`` left out: unreadable files and refused rows."""
    return spark.read.schema(REJECTS).parquet(f"{path.rstrip('/')}_rejects")


def _dated(scanned: DataFrame, bad: DataFrame, kind: str, path: str) -> DataFrame:
    """Rows with their day; what is left out is written beside ``path``. A row without an id stays,
    as results are keyed by file and row."""
    fine, refused = sort_out(scanned, KINDS[kind], allow_null_key=True)
    refused.unionByName(unreadable(bad)).write.mode("overwrite").parquet(f"{path.rstrip('/')}_rejects")
    return fine.withColumnRenamed("date", "day")


def classify(
    spark: SparkSession, root: str, make_scorer: MakeScorer, path: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Results and failures of all subtitles under a folder; a second run does what is left.

    Rows are spread over all tasks by default, since scoring costs far more than moving them. What
    could not be read or has no date is in ``rejects_of(spark, path)``.
    """
    scanned, bad = scan_kind(spark, root, "subtitles", strict=True)
    require_columns(scanned, ["content"], "subtitles")
    rows = _dated(scanned, bad, "subtitles", path).select(
        "meta_id", *ROW_KEY, "year", "month", "day", "content"
    )
    options = {"spread_by": ROW_KEY, **options}
    done, failed = score_resumable(rows, "content", make_scorer, ROW_KEY, path, **options)
    return done.select(*RESULT_COLUMNS), failed


def merge(spark: SparkSession, classified_path: str, root: str, output: str) -> DataFrame:
    """Classified rows joined to the metadata drops under a folder, written and read back.

    Drops of days that have no classified rows are left out of the scan by their names. Where no
    drop is left the result is empty and has all columns. What could not be read is in
    ``rejects_of(spark, output)``.
    """
    classified = load_classified(spark, classified_path)
    name = base_name("path")
    drops = list_files(spark, root, "*_metadata.parquet", recursive=True).withColumns({
        "year": file_year(name), "month": file_month(name), "day": file_day(name),
    })
    days = classified.select("year", "month", "day").distinct()
    scanned, bad = scan_files(drops.join(days, ["year", "month", "day"], "left_semi"), kind=KINDS["metadata"])
    metadata = _dated(scanned, bad, "metadata", output).drop(MISFITS.name)
    write_result(classified_join(classified, metadata), output)
    return spark.read.parquet(output)
