"""The library's functions for use in SQL text, defined in SQL: no Python runs when they are called."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name of the view that ``parallel_progress`` reads: the tracking rows of all archives.
TRACKING = "parallel_job_tracking"

_FOLDER_NAME = """
CREATE OR REPLACE TEMPORARY FUNCTION get_folder_name(year INT, month INT, location STRING DEFAULT 'zurich')
RETURNS STRING
RETURN concat_ws('_', location, CAST(year AS STRING), lower(date_format(make_date(year, month, 1), 'MMMM')))"""

_PROGRESS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION parallel_progress(job BIGINT)
RETURNS TABLE(archives BIGINT, files_processed BIGINT, files_failed BIGINT)
RETURN SELECT count(*), CAST(coalesce(sum(files_processed), 0) AS BIGINT), CAST(coalesce(sum(files_failed), 0) AS BIGINT)
  FROM {TRACKING} WHERE master_job_id = parallel_progress.job"""


def register_folder_name(spark: SparkSession) -> None:
    """``get_folder_name(year, month, location)``, as ``functions.folder_name`` gives it."""
    spark.sql(_FOLDER_NAME)


def register_progress(spark: SparkSession) -> None:
    """The table function ``parallel_progress(job)``: one row of sums over the job's archives.

    It reads the view ``parallel_job_tracking``, which must be there. Called for many jobs with
    LATERAL it becomes one aggregation and a join.
    """
    spark.sql(_PROGRESS)
