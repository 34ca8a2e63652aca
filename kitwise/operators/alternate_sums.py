"""Part metrics summed over related (alternate) parts, in one pass.

Inventory (G2), receipts (F8), this week's receipts (F9) and the supply plan
(K3) all sum per-part figures over the same related sets of the report's
parts. They are joined into one per-part table and summed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.operators.alternates import sum_over_alternates
from kitwise.operators.inventory import INVENTORY_METRICS

ALTERNATE_SUM_COLUMNS = (*INVENTORY_METRICS, "received_4w", "received_8w", "current_week_supply", "_plan4", "_plan8")


def part_figures(inv: DataFrame, receipt_sums: DataFrame, supply: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per part with every figure that is summed over alternates.

    A part missing from a source counts 0 for that source; a plan window whose
    quantities are all NULL stays NULL, as the plan sum itself would be.
    """
    j = (
        inv.select("part_number", *INVENTORY_METRICS)
        .join(receipt_sums.select("part_number", "received_4w", "received_8w"), "part_number", "full")
        .join(supply.select("part_number", "current_week_supply"), "part_number", "full")
        .join(plans.select("part_number", "_plan4", "_plan8", "_has_plan"), "part_number", "full")
    )
    zero = F.lit(0.0)
    return j.where(F.col("part_number").isNotNull()).select(
        "part_number",
        *[F.coalesce(F.col(c), zero).alias(c) for c in INVENTORY_METRICS],
        F.coalesce(F.col("received_4w"), zero).alias("received_4w"),
        F.coalesce(F.col("received_8w"), zero).alias("received_8w"),
        F.coalesce(F.col("current_week_supply"), zero).alias("current_week_supply"),
        *[F.when(F.col("_has_plan").isNull(), zero).otherwise(F.col(c)).alias(c) for c in ("_plan4", "_plan8")],
    )


def alternate_sums(base: DataFrame, groups: DataFrame, figures: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """Every figure of ``part_figures`` summed over each base part's related set."""
    return sum_over_alternates(base, groups, figures, list(ALTERNATE_SUM_COLUMNS), classes=classes, links=links)
