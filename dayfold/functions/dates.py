"""Dates in names, day texts, month names and folder names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..model import MONTHS
from .text import as_column, whole_number

FILE_DATE = r"\d{4}-\d{2}-\d{2}"
ARCHIVE_SLOT = r"0_\d{4}-\d{2}-\d{2}_(\d{2}_\d{2})\.tar\.xz"
FOLDER = r"^([a-z]+)_([0-9]{4})_([a-z]+)$"


def day_text(year, month, date) -> Column:
    """``Y-MM-DD`` with the month and day padded to two digits; null if a part is null."""
    return F.concat(
        as_column(year).cast("string"),
        F.lit("-"),
        F.lpad(as_column(month).cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(as_column(date).cast("string"), 2, "0"),
    )


def is_day_text(text) -> Column:
    return as_column(text).rlike(r"^\d{4}-\d{2}-\d{2}$")


def has_file_date(name) -> Column:
    return as_column(name).rlike(FILE_DATE)


def _file_part(name, start: int, length: int) -> Column:
    # The same extract in all three parts, so Spark runs it once per row.
    found = F.nullif(F.regexp_extract(as_column(name), FILE_DATE, 0), F.lit(""))
    return F.substring(found, start, length).cast("int")


def file_year(name) -> Column:
    """Year of the first date in a name, null where there is none."""
    return _file_part(name, 1, 4)


def file_month(name) -> Column:
    return _file_part(name, 6, 2)


def file_day(name) -> Column:
    return _file_part(name, 9, 2)


def slot_of_archive(name) -> Column:
    """``HH_MM`` of an archive name, null where the name has none."""
    found = F.regexp_extract(as_column(name), ARCHIVE_SLOT, 1)
    return F.when(found != "", found)


def _month_names() -> Column:
    pairs = []
    for number, name in enumerate(MONTHS, start=1):
        for text in dict.fromkeys([name, name[:3]]):
            pairs += [F.lit(text), F.lit(number)]
    pairs += [F.lit("sept"), F.lit(9)]
    return F.create_map(*pairs)


def month_number(text) -> Column:
    """Month of a name, an abbreviation or a number 1..12, whatever the case; else null."""
    low = F.lower(as_column(text))
    number = whole_number(low, "int")
    return F.coalesce(
        F.element_at(_month_names(), low),
        F.when(number.between(1, 12), number),
    )


def in_year_range(year) -> Column:
    return as_column(year).between(2000, 2030)


def in_day_range(date) -> Column:
    """1..31, whatever the month."""
    return as_column(date).between(1, 31)


def folder_name(location, year, month) -> Column:
    """``<location>_<year>_<month name>``."""
    first = F.make_date(as_column(year), as_column(month), F.lit(1))
    return F.concat_ws(
        "_",
        as_column(location),
        as_column(year).cast("string"),
        F.lower(F.date_format(first, "MMMM")),
    )


def folder_month(name) -> Column:
    """Month of a folder name; only full lower-case month names count."""
    word = F.regexp_extract(as_column(name), FOLDER, 3)
    return F.when(word.isin(MONTHS), month_number(word))


def parse_folder(name) -> Column:
    """Struct ``location, year, month, day_text, error`` of a folder name.

    The day is the first of the month. ``error`` is ``shape`` or ``month`` where the name
    cannot be used, and null otherwise.
    """
    text = as_column(name)
    fits = text.rlike(FOLDER)
    year = F.nullif(F.regexp_extract(text, FOLDER, 2), F.lit("")).cast("int")
    month = folder_month(text)
    good = fits & month.isNotNull()
    return F.struct(
        F.when(good, F.regexp_extract(text, FOLDER, 1)).alias("location"),
        F.when(good, year).alias("year"),
        F.when(good, month).alias("month"),
        F.when(good, day_text(year, month, F.lit(1))).alias("day_text"),
        F.when(~fits, "shape").when(month.isNull(), "month").alias("error"),
    )
