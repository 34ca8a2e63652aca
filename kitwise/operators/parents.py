"""Stock inside parent assemblies and their alternates (stages I1-I7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.functions.math import safe_div
from kitwise.functions.text import is_child_row, not_text_true, text_key
from kitwise.operators.alternates import alternate_bridge, alternates_of, sum_over_alternates
from kitwise.params import ReportParams


def parent_alternate_candidates(usage: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct (line, parent, ratio, alternate of the parent)."""
    parents = usage.select(F.col("parent_part_number").alias("part_number")).distinct()
    bridge = alternate_bridge(parents, groups).where(F.col("related_part_number") != F.col("base_part_number"))
    j = usage.join(bridge, usage["parent_part_number"] == bridge["base_part_number"])
    return j.select(
        "path",
        "parent_part_number",
        "child_quantity_in_parent",
        F.col("related_part_number").alias("alternate_parent_part_number"),
    ).distinct()


def alt_parent_latest_rev(usage: DataFrame, groups: DataFrame, bom: DataFrame) -> DataFrame:
    """Largest revision of each alternate parent (of ``parent_alternate_candidates``) that is a root anywhere."""
    parents = usage.select(F.col("parent_part_number").alias("part_number"))
    alts = alternates_of(parents, groups).select(F.col("part_number").alias("_alt"))
    rows = bom.where(F.col("part_number").isNotNull()).select("top_level_bom", "top_level_revision")
    j = rows.join(alts, rows["top_level_bom"] == alts["_alt"])
    return j.groupBy(F.col("_alt").alias("alternate_parent_part_number")).agg(
        F.max(text_key(F.col("top_level_revision"))).alias("top_level_revision")
    )


def alt_parent_requirements(latest_rev: DataFrame, bom: DataFrame, p: ReportParams) -> DataFrame:
    """Required quantity per (alternate parent, bought, non-consumable component)."""
    rows = bom.where(
        F.col("part_number").isNotNull()
        & (F.col("adjusted_procurement_intent") == p.buy_intent)
        & not_text_true(F.col("is_consumable_storable"))
        & is_child_row(F.col("parent_bom"), F.col("indent_level"))
        & (F.coalesce(F.col("adjusted_quantity"), F.lit(0.0)) > 0)
    ).select(
        "part_number",
        F.col("top_level_bom").alias("_root"),
        text_key(F.col("top_level_revision")).alias("_root_key"),
        F.coalesce(F.col("adjusted_quantity"), F.lit(0.0)).alias("_qty"),
    )
    lr = latest_rev.select(F.col("alternate_parent_part_number"), F.col("top_level_revision").alias("_rev"))
    j = rows.join(lr, (rows["_root"] == lr["alternate_parent_part_number"]) & (rows["_root_key"] == lr["_rev"]))
    return j.groupBy("alternate_parent_part_number", F.col("part_number").alias("component_part_number")).agg(
        F.sum("_qty").alias("component_required_quantity")
    )


def alt_component_supply(
    requirements: DataFrame, groups: DataFrame, inv: DataFrame, transit: DataFrame, net_this_week: DataFrame
) -> DataFrame:
    """I4: per component over its related parts: available on hand (and with in transit)."""
    comps = requirements.select(F.col("component_part_number").alias("part_number")).distinct()
    metrics = (
        inv.select("part_number", F.coalesce(F.col("on_hand"), F.lit(0.0)).alias("_oh"))
        .join(
            transit.select("part_number", F.coalesce(F.col("in_transit_quantity"), F.lit(0.0)).alias("_it")),
            "part_number",
            "full",
        )
        .join(
            net_this_week.select(
                "part_number", F.coalesce(F.col("current_week_net_demand"), F.lit(0.0)).alias("_nd")
            ),
            "part_number",
            "full",
        )
        .where(F.col("part_number").isNotNull())
        .select("part_number", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("_oh", "_it", "_nd")])
    )
    s = sum_over_alternates(comps, groups, metrics, ["_oh", "_it", "_nd"])
    return s.select(
        F.col("part_number").alias("component_part_number"),
        F.greatest(F.col("_oh") - F.col("_nd"), F.lit(0.0)).alias("available_on_hand"),
        F.greatest(F.col("_oh") + F.col("_it") - F.col("_nd"), F.lit(0.0)).alias("available_with_in_transit"),
    )


def buildable_sets(requirements: DataFrame, supply: DataFrame) -> DataFrame:
    """Sets of each alternate parent its scarcest component allows (0 if none)."""
    j = requirements.join(supply, "component_part_number", "left")
    req = F.col("component_required_quantity")
    return j.groupBy("alternate_parent_part_number").agg(
        F.coalesce(F.min(safe_div(F.col("available_on_hand"), req)), F.lit(0.0)).alias("sets_on_hand"),
        F.coalesce(F.min(safe_div(F.col("available_with_in_transit"), req)), F.lit(0.0)).alias(
            "sets_with_in_transit"
        ),
    )


def line_parent_alternates(
    candidates: DataFrame, inv: DataFrame, transit: DataFrame, sets: DataFrame
) -> DataFrame:
    """Per line, stock of alternates of its parents times ratio, and their sets."""
    key = "alternate_parent_part_number"
    j = (
        candidates.join(inv.select(F.col("part_number").alias(key), "on_hand"), key, "left")
        .join(transit.select(F.col("part_number").alias(key), "in_transit_quantity"), key, "left")
        .join(sets, key, "left")
    )
    ratio = F.coalesce(F.col("child_quantity_in_parent"), F.lit(0.0))
    return j.groupBy("path").agg(
        F.sum(F.coalesce(F.col("on_hand"), F.lit(0.0)) * ratio).cast("double").alias("on_hand_in_alt_parents"),
        F.sum(F.coalesce(F.col("in_transit_quantity"), F.lit(0.0)) * ratio)
        .cast("double")
        .alias("in_transit_in_alt_parents"),
        F.sum(F.coalesce(F.col("sets_on_hand"), F.lit(0.0))).cast("double").alias("sets_of_alt_parents"),
        F.sum(F.coalesce(F.col("sets_with_in_transit"), F.lit(0.0)))
        .cast("double")
        .alias("sets_with_in_transit_of_alt_parents"),
    )


def line_parent_stock(usage: DataFrame, inv: DataFrame, assembly_rollup: DataFrame) -> DataFrame:
    """Per line, on hand of its ancestors times ratio, and ancestor sets."""
    j = usage.join(
        inv.select(F.col("part_number").alias("parent_part_number"), "on_hand"), "parent_part_number", "left"
    ).join(assembly_rollup, ["parent_part_number", "top_level_bom", "top_level_revision"], "left")
    roll = F.col("parent_rolled_up_quantity")
    usable = roll.isNotNull() & (roll != 0)
    oh = F.coalesce(F.col("on_hand"), F.lit(0.0))
    return j.groupBy("path").agg(
        F.sum(oh * F.coalesce(F.col("child_quantity_in_parent"), F.lit(0.0))).cast("double").alias(
            "on_hand_in_parents"
        ),
        F.sum(F.when(usable, oh / roll).otherwise(F.lit(0.0))).cast("double").alias("sets_in_parents"),
        F.count(F.when(usable, F.lit(1))).alias("valid_parent_count"),
    )
