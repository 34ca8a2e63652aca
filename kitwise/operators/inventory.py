"""Inventory (stages G1-G2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.params import QUARANTINE, RECEIVING, STOCK_CATEGORIES, ReportParams

INVENTORY_METRICS = ("on_hand", "on_hand_value", "receiving", "quarantine")


def inventory_by_part(inventory: DataFrame, categories: DataFrame, cost: DataFrame, p: ReportParams) -> DataFrame:
    """G1: on hand (stock categories), its value, receiving only, quarantine.

    Quantities are summed per part before the cost lookup; the value is the
    on-hand sum times the part's cost (the cost is one number per part).
    """
    c = p.columns
    inv = inventory.select(
        F.col(c.inventory_part).alias("part_number"),
        F.col(c.inventory_quantity).cast("double").alias("_qty"),
        F.col(c.inventory_location).alias("_loc"),
    )
    cat = categories.select(F.col("id").alias("_loc"), "category")
    q = F.col("_qty")
    sums = (
        inv.join(cat, "_loc", "left")
        .groupBy("part_number")
        .agg(
            F.sum(F.when(F.col("category").isin(*STOCK_CATEGORIES), q).otherwise(F.lit(0.0))).alias("on_hand"),
            F.sum(F.when(F.col("category") == RECEIVING, q).otherwise(F.lit(0.0))).alias("receiving"),
            F.sum(F.when(F.col("category") == QUARANTINE, q).otherwise(F.lit(0.0))).alias("quarantine"),
        )
    )
    pc = cost.select(F.col("part_number").alias("_cost_part"), F.col("unit_cost").alias("_cost"))
    j = sums.join(pc, sums["part_number"] == pc["_cost_part"], "left")
    return j.select(
        "part_number",
        "on_hand",
        (F.col("on_hand") * F.coalesce(F.col("_cost"), F.lit(0.0))).alias("on_hand_value"),
        "receiving",
        "quarantine",
    )


def inventory_alt(alt_sums: DataFrame) -> DataFrame:
    """G1 summed over each part's related parts (each at its own cost)."""
    return alt_sums.select("part_number", *[F.col(x).alias(f"{x}_alt") for x in INVENTORY_METRICS])
