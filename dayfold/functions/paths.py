"""Names and paths of media files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column


def base_name(path) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def file_stem(path) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def archive_stem(path) -> Column:
    """Base name of an archive without ``.tar``, ``.tar.gz`` or ``.tar.xz``."""
    return F.regexp_replace(base_name(path), r"\.tar(\.gz|\.xz)?$", "")


def extension_swapped(archive, member, old=".mp3", new=".opus") -> Column:
    """``<archive stem>/<member stem><new>``, where the converted member is put."""
    stem = F.regexp_replace(base_name(member), old.replace(".", r"\.") + "$", "")
    return F.concat(archive_stem(archive), F.lit("/"), stem, F.lit(new))


def storage_path(year, month, date, slot, name) -> Column:
    """``audio/Y/MM/DD/slot/name``."""
    two = [F.lpad(as_column(part).cast("string"), 2, "0") for part in (month, date)]
    parts = [F.lit("audio"), as_column(year).cast("string"), *two, as_column(slot), as_column(name)]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("/"), part)
    return joined
