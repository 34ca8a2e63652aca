"""Column-expression helpers. All return ``Column``; none is a UDF."""

from kitwise.functions.dates import days_between, parse_mdy, parse_md_in_year, week_offset, week_start
from kitwise.functions.math import coverage, coverage_in_transit, safe_div
from kitwise.functions.paths import plain_path, plain_path_inline
from kitwise.functions.rules import classify_by_rules, movement_category, movement_quantity
from kitwise.functions.text import (
    is_child_row,
    normalize_status,
    not_text_true,
    split_part_list,
    text_key,
)

__all__ = [
    "classify_by_rules",
    "coverage",
    "coverage_in_transit",
    "days_between",
    "is_child_row",
    "movement_category",
    "movement_quantity",
    "normalize_status",
    "not_text_true",
    "parse_md_in_year",
    "parse_mdy",
    "plain_path",
    "plain_path_inline",
    "safe_div",
    "split_part_list",
    "text_key",
    "week_offset",
    "week_start",
]
