"""Guarded arithmetic and the weekly coverage rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with NULL instead of an error when ``den`` is 0."""
    return num / F.nullif(den, F.lit(0))


def coverage(stock: Column, prior: Column, demand: Column) -> Column:
    """Fraction of one week's demand that stock still covers.

    ``prior`` is the demand of all earlier weeks. A week without demand counts
    as covered as long as earlier demand has not used more than the stock.
    """
    left = stock - prior
    return (
        F.when(prior > stock, F.lit(0.0))
        .when(demand <= 0, F.lit(1.0))
        .when(left >= demand, F.lit(1.0))
        .otherwise(F.greatest(left, F.lit(0.0)) / demand)
    )


def coverage_in_transit(transit: Column, prior: Column, demand: Column) -> Column:
    """As ``coverage`` but nothing in transit covers nothing."""
    return F.when(transit <= 0, F.lit(0.0)).otherwise(coverage(transit, prior, demand))
