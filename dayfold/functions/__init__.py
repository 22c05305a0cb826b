"""Column expressions. Every function takes columns or names and returns a column."""

from .dates import (
    day_text, file_day, file_month, file_year, folder_month, folder_name, has_file_date,
    in_day_range, in_year_range, is_day_text, month_number, parse_folder, slot_of_archive,
)
from .paths import archive_stem, base_name, extension_swapped, file_stem, storage_path
from .text import TEMPLATE_SLOT, fill_template, is_blank, nonblank, split_words, strip, whole_number
from .values import (
    argmax_index, common_type, elapsed_seconds, elapsed_text, flag, label_of_token, seconds_of_samples,
    softmax, surrogate_id, zero_if_null,
)

__all__ = [
    "TEMPLATE_SLOT", "archive_stem", "argmax_index", "base_name", "common_type", "day_text",
    "elapsed_seconds", "elapsed_text", "extension_swapped", "file_day", "file_month",
    "file_stem", "file_year", "fill_template", "flag", "folder_month", "folder_name",
    "has_file_date", "in_day_range", "in_year_range", "is_blank", "is_day_text",
    "label_of_token", "month_number", "nonblank", "parse_folder", "seconds_of_samples",
    "slot_of_archive", "softmax", "split_words", "storage_path", "strip", "surrogate_id",
    "whole_number", "zero_if_null",
]
