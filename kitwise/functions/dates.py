"""Date helpers. Weeks start on Monday and stay ``DateType``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(c: Column) -> Column:
    """Monday of the week of a date or timestamp, as a date."""
    return F.trunc(F.to_date(c), "week")


def parse_mdy(c: Column) -> Column:
    """``MM/DD/YYYY`` text to date; unparsable text gives NULL."""
    return F.try_to_date(c, "M/d/yyyy")


def parse_md_in_year(c: Column, year: int) -> Column:
    """``MM/DD`` text completed with ``year`` (trimmed first)."""
    return parse_mdy(F.concat(F.trim(c), F.lit(f"/{year}")))


def days_between(start: Column, end: dt.date | Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    end_c = F.lit(end) if isinstance(end, dt.date) else end
    return F.datediff(end_c, F.to_date(start))


def week_offset(week: Column, week0: dt.date) -> Column:
    """Whole weeks between two Mondays."""
    return F.floor(F.datediff(week, F.lit(week0)) / F.lit(7)).cast("int")
