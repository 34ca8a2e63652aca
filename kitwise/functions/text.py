"""Text helpers: keys, blanks, text booleans, part lists, statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(c: Column) -> Column:
    """Join key where NULL and '' are the same value."""
    return F.coalesce(c, F.lit(""))


def is_child_row(parent: Column, indent: Column) -> Column:
    """A hierarchy row below the root: a non-blank parent or indent > 0."""
    return F.nullif(F.trim(parent), F.lit("")).isNotNull() | (F.coalesce(indent, F.lit(0)) > 0)


def not_text_true(c: Column) -> Column:
    """True unless the text parses as boolean true (t, true, y, yes, on, 1; NULL and junk are false)."""
    text = c.cast("string")
    return ~F.coalesce(text.try_cast("boolean") | (F.lower(F.trim(text)) == "on"), F.lower(F.trim(text)) == "on", F.lit(False))


def split_part_list(c: Column) -> Column:
    """Comma text to a distinct array of trimmed, non-empty part numbers."""
    items = F.transform(F.split(c, ","), lambda x: F.trim(x))
    return F.array_distinct(F.filter(items, lambda x: x != F.lit("")))


def normalize_status(c: Column) -> Column:
    """Upper case, runs of anything but letters and digits to '_'; NULL to ''."""
    return F.coalesce(F.regexp_replace(F.upper(F.trim(c)), "[^A-Z0-9]+", "_"), F.lit(""))
