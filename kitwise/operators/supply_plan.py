"""Supply plan (stages K1-K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.functions.dates import parse_md_in_year, week_start
from kitwise.params import ReportParams


def supply_plan_rows(plans: DataFrame, p: ReportParams) -> DataFrame:
    """K1: plan rows; ``MM/DD`` text completed with the as-of year."""
    c = p.columns
    d = parse_md_in_year(F.col(c.plan_date), p.as_of.year)
    return plans.select(
        F.col(c.plan_part).alias("part_number"),
        F.col(c.plan_quantity).cast("double").alias("quantity"),
        d.alias("plan_date"),
        week_start(d).alias("plan_week"),
    )


def plan_sums(rows: DataFrame, p: ReportParams) -> DataFrame:
    """Per part with a parsable plan row: planned quantity of the next 4 and 8 weeks."""
    w = F.col("plan_week")
    q = F.col("quantity")
    next4 = (w >= F.lit(p.week0)) & (w < F.lit(p.week(4)))
    next8 = (w >= F.lit(p.week0)) & (w < F.lit(p.week(8)))
    return (
        rows.where(F.col("plan_date").isNotNull())
        .groupBy("part_number")
        .agg(
            F.sum(F.when(next4, q).otherwise(F.lit(0.0))).alias("_plan4"),
            F.sum(F.when(next8, q).otherwise(F.lit(0.0))).alias("_plan8"),
            F.lit(True).alias("_has_plan"),
        )
    )


def _net_plan(realized: str, suffix: str):
    r = F.coalesce(F.col(realized), F.lit(0.0))
    t4 = F.col("_plan4") - r
    t8 = F.col("_plan8") - r
    return [
        r.alias(f"current_week_supply{suffix}"),
        t4.alias(f"plan_total_4w{suffix}"),
        t8.alias(f"plan_total_8w{suffix}"),
        (t4 / F.lit(4.0)).alias(f"plan_avg_4w{suffix}"),
        (t8 / F.lit(8.0)).alias(f"plan_avg_8w{suffix}"),
    ]


def supply_plan(rows: DataFrame, supply: DataFrame, p: ReportParams) -> DataFrame:
    """K2: plan totals and averages for the next 4 and 8 weeks minus this week's receipts.

    Only parts with a parsable plan row get a row.
    """
    j = plan_sums(rows, p).join(supply, "part_number", "left")
    return j.select("part_number", *_net_plan("current_week_supply", ""))


def supply_plan_alt(alt_sums: DataFrame) -> DataFrame:
    """K3: K2 over each part's related parts, for every base part.

    ``alt_sums`` holds the plan windows and this week's receipts summed over
    related parts (``alternate_sums``).
    """
    return alt_sums.select("part_number", *_net_plan("current_week_supply", "_alt"))
