"""Hierarchy scope and rollup (stages A1-A9).

A root (top-level product) is in scope when it has demand from the as-of week
on. Lines are hierarchy rows under an in-scope root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.functions.dates import parse_mdy, week_start
from kitwise.functions.math import safe_div
from kitwise.functions.paths import plain_path
from kitwise.functions.text import is_child_row, text_key
from kitwise.operators.intervals import prefix_pairs
from kitwise.params import ReportParams

LINE_COLUMNS = (
    "path",
    "part_number",
    "revision",
    "product_name",
    "production_state",
    "indent_level",
    "uom",
    "tracking",
    "is_consumable_storable",
    "parent_bom",
    "parent_revision",
    "top_level_bom",
    "top_level_revision",
    "quantity",
    "procurement_intent",
    "adjusted_quantity",
    "adjusted_procurement_intent",
    "global_alternate_part_numbers",
    "substitute_part_numbers",
)


def eligible_roots(demand: DataFrame, p: ReportParams) -> DataFrame:
    """A1: distinct (part, revision) with positive demand in a week >= W0."""
    week = week_start(parse_mdy(F.col("date")))
    return (
        demand.where(
            F.col("part_number").isNotNull()
            & (F.coalesce(F.col("quantity"), F.lit(0.0)) > 0)
            & (week >= F.lit(p.week0))
        )
        .select("part_number", "revision")
        .distinct()
    )


def child_parts(bom: DataFrame) -> DataFrame:
    """A3: distinct parts that occur below a root anywhere in the hierarchy."""
    return (
        bom.where(F.col("part_number").isNotNull() & is_child_row(F.col("parent_bom"), F.col("indent_level")))
        .select("part_number")
        .distinct()
    )


def demanded_roots(eligible: DataFrame, children: DataFrame) -> DataFrame:
    """A2: eligible roots that are nobody's child (revision ignored)."""
    return eligible.join(children, "part_number", "left_anti")


def _root_match(lines: DataFrame, roots: DataFrame, how: str) -> DataFrame:
    r = roots.select(F.col("part_number").alias("_root"), text_key(F.col("revision")).alias("_root_key"))
    cond = (lines["top_level_bom"] == r["_root"]) & (text_key(lines["top_level_revision"]) == r["_root_key"])
    return lines.join(r, cond, how)


def scoped_lines(bom: DataFrame, eligible: DataFrame, p: ReportParams) -> DataFrame:
    """A4 + A5: distinct hierarchy rows under an eligible root, plus plain path."""
    rows = _root_match(bom.select(*LINE_COLUMNS), eligible, "left_semi").distinct()
    return rows.withColumn("path_without_revision", plain_path(F.col("path"), p.revision_pattern))


def _in_demanded_roots(lines: DataFrame, demanded: DataFrame) -> DataFrame:
    # Inner join on purpose: a root listed with both a NULL and a '' revision
    # matches twice, as in the report.
    return _root_match(lines, demanded, "inner").drop("_root", "_root_key")


def part_root_rollup(lines: DataFrame, demanded: DataFrame, p: ReportParams) -> DataFrame:
    """Summed adjusted quantity per (part, root, root revision) of bought lines."""
    rows = _in_demanded_roots(
        lines.where(
            F.col("part_number").isNotNull()
            & F.col("top_level_bom").isNotNull()
            & (F.col("adjusted_procurement_intent") == p.buy_intent)
        ),
        demanded,
    )
    return rows.groupBy(
        "part_number", "top_level_bom", text_key(F.col("top_level_revision")).alias("top_level_revision")
    ).agg(F.sum(F.coalesce(F.col("adjusted_quantity"), F.lit(0.0))).alias("total_rolled_up_quantity"))


def own_roots(rows: DataFrame, children: DataFrame) -> DataFrame:
    """Roots (part, revision) named by ``rows`` that are nobody's child."""
    roots = rows.where(F.col("top_level_bom").isNotNull()).select(
        F.col("top_level_bom").alias("part_number"), text_key(F.col("top_level_revision")).alias("revision")
    )
    return demanded_roots(roots.distinct(), children)


def rollup_of_rows(rows: DataFrame, p: ReportParams) -> DataFrame:
    """A6 + A7 for report rows that are their own hierarchy.

    Roots and child parts are read from ``rows`` instead of the demand and the
    full hierarchy, for reports whose source gives finished rows. Returns
    ``rows`` with ``total_rolled_up_quantity``: a column of that name is read
    as numbers (text that is none gives NULL); otherwise each part gets its
    largest sum per root (NULL for parts that no root buys).
    """
    if "total_rolled_up_quantity" in rows.columns:
        return rows.withColumn("total_rolled_up_quantity", F.col("total_rolled_up_quantity").try_cast("double"))
    amounts = rows.withColumn("adjusted_quantity", F.col("adjusted_quantity").try_cast("double"))
    rollup = part_rollup(part_root_rollup(amounts, own_roots(rows, child_parts(rows)), p))
    return rows.join(rollup, "part_number", "left").select(*rows.columns, "total_rolled_up_quantity")


def part_rollup(root_rollup: DataFrame) -> DataFrame:
    """Largest per-root rollup of each part."""
    return root_rollup.groupBy("part_number").agg(
        F.max("total_rolled_up_quantity").cast("double").alias("total_rolled_up_quantity")
    )


def assembly_root_rollup(lines: DataFrame, demanded: DataFrame, children: DataFrame) -> DataFrame:
    """Summed adjusted quantity per (assembly, root, root revision)."""
    rows = _in_demanded_roots(
        lines.where(F.col("part_number").isNotNull() & F.col("top_level_bom").isNotNull()), demanded
    ).join(children, "part_number", "left_semi")
    return rows.groupBy(
        F.col("part_number").alias("parent_part_number"),
        "top_level_bom",
        text_key(F.col("top_level_revision")).alias("top_level_revision"),
    ).agg(F.sum(F.coalesce(F.col("adjusted_quantity"), F.lit(0.0))).cast("double").alias("parent_rolled_up_quantity"))


def ancestor_usage(lines: DataFrame, children: DataFrame) -> DataFrame:
    """Every (line, strict path ancestor in the same root) pair.

    The ancestor must be an assembly (a part that occurs as a child). The ratio
    is the line's adjusted quantity over the ancestor's (NULL when that is 0).

    Lines are not joined with lines on a prefix test: one sort of the paths
    numbers the lines so that an ancestor's lines are an interval, and the
    intervals meet the line numbers in bins (``intervals.prefix_pairs``).
    """
    in_root = [F.col("top_level_bom"), text_key(F.col("top_level_revision")).alias("top_level_revision"), F.col("path_without_revision")]
    quantity = F.coalesce(F.col("adjusted_quantity"), F.lit(0.0))
    anc = lines.join(children, "part_number", "left_semi").select(
        *in_root, F.col("part_number").alias("parent_part_number"), quantity.alias("_in_ancestor")
    )
    child = lines.where(F.col("part_number").isNotNull()).select(*in_root, "path", quantity.alias("_in_line"))
    pairs = prefix_pairs(child, anc, ["top_level_bom", "top_level_revision"], "path_without_revision")
    return pairs.select(
        "path",
        "parent_part_number",
        "top_level_bom",
        "top_level_revision",
        safe_div(F.col("_in_line"), F.col("_in_ancestor")).alias("child_quantity_in_parent"),
    )
