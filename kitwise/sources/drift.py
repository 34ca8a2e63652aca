"""Schema-drift tolerant column access.

Some sources change their column names over time. The report reads a value
from the first candidate column that exists (and, for typed reads, parses).
Candidates are resolved against ``df.columns`` when the plan is built, so the
scan still prunes to the columns that exist and no row is turned into a map.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, candidates: Iterable[str | None]) -> list[str]:
    """Candidates that exist in ``df`` (case-insensitive), first wins, no repeats."""
    by_lower = {c.lower(): c for c in df.columns}
    out: list[str] = []
    for c in candidates:
        if c is None:
            continue
        hit = by_lower.get(c.lower())
        if hit is not None and hit not in out:
            out.append(hit)
    return out


def with_row_object(df: DataFrame, column: str | None) -> DataFrame:
    """``df`` with its row object as VARIANT.

    ``column`` holds each row's fields as one object, as VARIANT or as JSON
    text; text that is no JSON has no fields. Without such a column ``df``
    stays as it is.
    """
    name = next(iter(present(df, [column])), None)
    if name is None or df.schema[name].dataType.typeName() == "variant":
        return df
    return df.withColumn(name, F.try_parse_json(F.col(name).cast("string")))


def _values(df: DataFrame, candidates: Iterable[str | None], row_object: str | None) -> list[Column]:
    """Each candidate's values as text: its column, then its field of the row object.

    Columns are looked up when the plan is built, fields row by row, so rows may
    have different ones. A field's name is read as given, in lower and in upper case.
    """
    whole = next(iter(present(df, [row_object])), None)
    if whole is None:
        return [F.col(c).cast("string") for c in present(df, candidates)]
    out = []
    for c in dict.fromkeys(c for c in candidates if c is not None):
        out += [F.col(x).cast("string") for x in present(df, [c])]
        out += [F.try_variant_get(F.col(whole), f"$['{k}']", "string") for k in dict.fromkeys((c, c.lower(), c.upper()))]
    return out


def first_text(df: DataFrame, candidates: Iterable[str | None], row_object: str | None = None) -> Column:
    """First non-NULL candidate as text; NULL when none exists."""
    cols = _values(df, candidates, row_object)
    if not cols:
        return F.lit(None).cast("string")
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def first_parsed(df: DataFrame, candidates: Iterable[str | None], dtype: str, row_object: str | None = None) -> Column:
    """First candidate whose text parses as ``dtype``; NULL when none does."""
    cols = [c.try_cast(dtype) for c in _values(df, candidates, row_object)]
    if not cols:
        return F.lit(None).cast(dtype)
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)
