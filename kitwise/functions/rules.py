"""Ordered rule tables turned into one ``CASE`` expression each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kitwise.params import MOVEMENT_RULES, STOCK_CATEGORIES, UNKNOWN, LocationRule


def classify_by_rules(c: Column, rules: Sequence[LocationRule], default: str = UNKNOWN) -> Column:
    """First rule whose LIKE pattern matches wins; else ``default``."""
    expr = None
    for rule in rules:
        cond = c.like(rule.pattern)
        expr = F.when(cond, F.lit(rule.category)) if expr is None else expr.when(cond, F.lit(rule.category))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def _side(c: Column, side: str) -> Column:
    if side == "stock":
        return c.isin(*STOCK_CATEGORIES)
    return c == F.lit(side)


def movement_category(origin: Column, dest: Column) -> Column:
    """Category of a move from its origin and destination categories."""
    expr = None
    for o, d, category, _ in MOVEMENT_RULES:
        cond = _side(origin, o) & _side(dest, d)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(UNKNOWN))


def movement_quantity(origin: Column, dest: Column, qty: Column) -> Column:
    """Signed quantity of a move; NULL for moves no rule knows."""
    expr = None
    for o, d, _, sign in MOVEMENT_RULES:
        cond = _side(origin, o) & _side(dest, d)
        val = qty if sign > 0 else -qty
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(None).cast("double"))
