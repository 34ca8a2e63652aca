"""Materialized-path helpers for the bill-of-materials hierarchy.

A path is pipe-delimited text such as ``|ROOT|A|SUB|B01|PART|C|`` where short
segments after each part are revisions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kitwise.params import INLINE_REVISION_PATTERN, REVISION_SEGMENT_PATTERN


def plain_path(c: Column, pattern: str = REVISION_SEGMENT_PATTERN) -> Column:
    """Path without revision segments (left-to-right, non-overlapping)."""
    return F.regexp_replace(c, pattern, "|")


def plain_path_inline(c: Column, pattern: str = REVISION_SEGMENT_PATTERN) -> Column:
    """Path without revisions, whichever of the two forms the path has.

    A path with inline revisions (``PART:REVx``) gives its parts joined by
    single pipes, without edge pipes; any other path loses its revision
    segments and its repeated pipes. NULL and '' stay as they are.
    """
    parts = F.filter(F.split(F.regexp_replace(c, INLINE_REVISION_PATTERN, ""), r"\|"), lambda x: x != "")
    return F.when(c.rlike(INLINE_REVISION_PATTERN), F.array_join(parts, "|")).otherwise(
        F.regexp_replace(plain_path(c, pattern), r"\|+", "|")
    )

