"""Day-intake text files: one day per line, with rejects by reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import in_day_range, in_year_range, month_number, strip, whole_number


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their number, 1 for the first line of a file.

    Files may be split over tasks. Lines are numbered within each block, which one task reads in
    order, and each block starts after the lines of the blocks before it.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lines.groupBy("file", "block")
        .agg(F.count("*").alias("n"))
        .select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    return (
        lines.withColumn("within", within)
        .join(starts, ["file", "block"])
        .select("file", (F.col("start") + F.col("within")).alias("line_no"), "line")
    )


def parse_lines(lines: DataFrame, *carry: str) -> tuple[DataFrame, DataFrame]:
    """Entries ``year, month, date, location`` and rejects ``line, reason`` of intake lines.

    Blank lines and lines that start with ``#`` are neither. The first rule that a line breaks
    gives the reason.
    """
    texts = lines.withColumn("text", strip("line")).filter(
        (F.col("text") != "") & ~F.col("text").startswith("#")
    )
    def field(place: int):
        return strip(F.get("parts", F.lit(place)))

    fields = texts.select(*carry, "line", F.split("text", ",").alias("parts")).select(
        *carry, "line",
        # As a generator this is evaluated once; the filters below would repeat plain columns.
        F.inline(F.array(F.struct(
            F.size("parts").alias("n"),
            whole_number(field(0)).alias("year"),
            month_number(field(1)).alias("month"),
            whole_number(field(2)).alias("date"),
            field(3).alias("location"),
        ))),
    ).withColumn(
        "reason",
        F.when(F.col("n") != 4, "field_count")
        .when(F.col("year").isNull() | F.col("date").isNull(), "not_integer")
        .when(F.col("month").isNull(), "bad_month")
        .when(~in_year_range("year"), "year_range")
        .when(~in_day_range("date"), "day_range"),
    )
    entries = fields.filter(F.col("reason").isNull()).select(
        *carry, F.col("year").cast("int"), "month", F.col("date").cast("int"), "location"
    )
    return entries, fields.filter(F.col("reason").isNotNull()).select(*carry, "line", "reason")


def read_queue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entries and rejects of intake files, each with file and line number."""
    return parse_lines(read_lines(spark, path), "file", "line_no")
