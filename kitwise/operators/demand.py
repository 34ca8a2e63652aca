"""Demand (stages B1-B8).

Demand is stated per root (finished product). A line's demand is the root's
demand times the line's adjusted quantity. The roots' demand is summed per
(root, revision key, type[, week]) first, which leaves a few rows per root,
and only then meets the lines; the lines never meet raw demand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitwise.functions.dates import parse_mdy, week_start
from kitwise.functions.text import text_key
from kitwise.params import DEMAND_TYPE_PRODUCTION, DEMAND_TYPE_SPARES, ReportParams


def demand_rows(demand: DataFrame) -> DataFrame:
    """B1: typed demand rows with their week; zero quantities stay."""
    d = parse_mdy(F.col("date"))
    return demand.where(F.col("part_number").isNotNull()).select(
        F.col("part_number").alias("top_level_bom"),
        F.col("revision").alias("top_level_revision"),
        F.col("quantity").cast("double").alias("demand_quantity"),
        F.col("demand_type"),
        d.alias("demand_date"),
        week_start(d).alias("demand_week"),
    )


def _windows(p: ReportParams) -> dict[str, Column]:
    w = F.col("demand_week")
    return {
        "past8": (w >= F.lit(p.week(-7))) & (w <= F.lit(p.week0)),
        "next4": (w >= F.lit(p.week0)) & (w < F.lit(p.week(4))),
        "next8": (w >= F.lit(p.week0)) & (w < F.lit(p.week(8))),
        "current": w == F.lit(p.week0),
    }


def root_demand_by_type(rows: DataFrame, p: ReportParams) -> DataFrame:
    """Window sums of demand per (root, revision key, type)."""
    q = F.col("demand_quantity")
    return rows.groupBy(
        F.col("top_level_bom").alias("_root"),
        text_key(F.col("top_level_revision")).alias("_root_key"),
        "demand_type",
    ).agg(
        *[F.sum(F.when(cond, q).otherwise(F.lit(0.0))).alias(f"_{name}") for name, cond in _windows(p).items()],
        F.lit(True).alias("_has_demand"),
    )


def _line_keys(lines: DataFrame) -> tuple[Column, Column]:
    return F.col("top_level_bom"), text_key(F.col("top_level_revision"))


def _scaled(name: str, qty: Column) -> Column:
    """Root window sum times line quantity; a root without demand gives 0."""
    return F.when(F.col("_has_demand").isNull(), F.lit(0.0)).otherwise(F.col(f"_{name}") * qty)


def line_gross_demand(lines: DataFrame, by_type: DataFrame) -> DataFrame:
    """B2: gross demand per (path, part, revision) over past 8 / next 4 / next 8 weeks."""
    per_root = by_type.groupBy("_root", "_root_key").agg(
        *[F.sum(f"_{n}").alias(f"_{n}") for n in ("past8", "next4", "next8")],
        F.lit(True).alias("_has_demand"),
    )
    root, key = _line_keys(lines)
    j = lines.join(per_root, (root == per_root["_root"]) & (key == per_root["_root_key"]), "left")
    qty = F.coalesce(F.col("adjusted_quantity"), F.lit(0.0))
    return j.groupBy("path", "part_number", "revision").agg(
        F.sum(_scaled("past8", qty)).alias("gross_past8"),
        F.sum(_scaled("next4", qty)).alias("gross_next4"),
        F.sum(_scaled("next8", qty)).alias("gross_next8"),
    )


def _part_root_quantity(lines: DataFrame) -> DataFrame:
    """Adjusted quantity of each (part, revision) summed per root."""
    return lines.groupBy(
        "part_number",
        "revision",
        F.col("top_level_bom").alias("_line_root"),
        text_key(F.col("top_level_revision")).alias("_line_key"),
    ).agg(F.sum(F.coalesce(F.col("adjusted_quantity"), F.lit(0.0))).alias("_qty"))


def part_gross_demand_by_type(lines: DataFrame, by_type: DataFrame) -> DataFrame:
    """Gross demand per (part, revision, type); type NULL when a part has none."""
    pr = _part_root_quantity(lines)
    j = pr.join(
        by_type,
        (pr["_line_root"] == by_type["_root"]) & (pr["_line_key"] == by_type["_root_key"]),
        "left",
    )
    qty = F.col("_qty")
    return j.groupBy("part_number", "revision", "demand_type").agg(
        F.sum(_scaled("past8", qty)).alias("gross_past8"),
        F.sum(_scaled("next8", qty)).alias("gross_next8"),
        F.sum(_scaled("current", qty)).alias("gross_current"),
    )


def part_gross_demand_this_week(gross_by_type: DataFrame) -> DataFrame:
    """Current-week gross demand per (part, revision), summed over types."""
    return gross_by_type.groupBy("part_number", "revision").agg(
        F.sum("gross_current").alias("current_week_gross")
    )


def root_weekly_by_type(rows: DataFrame, p: ReportParams) -> DataFrame:
    """Demand per (root, revision key, week >= W0, type)."""
    return (
        rows.where(F.col("demand_week") >= F.lit(p.week0))
        .groupBy(
            F.col("top_level_bom").alias("_root"),
            text_key(F.col("top_level_revision")).alias("_root_key"),
            "demand_week",
            "demand_type",
        )
        .agg(F.sum("demand_quantity").alias("_week_qty"))
    )


def _roots_of_parts(lines: DataFrame) -> DataFrame:
    """Per (part, revision) the array ``_roots`` of its roots with the quantity in each.

    Dealt by part into the session's number of shuffle partitions: these rows
    are small but each stands for all weeks of its roots, so they are not put
    together into the few tasks that their own size would call for.
    """
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    root = F.struct("_line_root", "_line_key", "_qty")
    return (
        _part_root_quantity(lines)
        .repartition(partitions, "part_number")
        .groupBy("part_number", "revision")
        .agg(F.collect_list(root).alias("_roots"))
    )


def _meet_weeks(parts: DataFrame, weekly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parts of one root and parts of several roots, each with a row for every root and row of ``weekly``.

    A part of one root has its sums already, so only the others need a grouping.
    """

    def meet(df: DataFrame, root: Column) -> DataFrame:
        df = df.select(*[c for c in df.columns if c != "_roots"], root.alias("_r")).select("*", "_r.*").drop("_r")
        return df.join(weekly, (F.col("_line_root") == weekly["_root"]) & (F.col("_line_key") == weekly["_root_key"]))

    n = F.size("_roots")
    return meet(parts.where(n == 1), F.element_at("_roots", 1)), meet(parts.where(n > 1), F.explode("_roots"))


def weekly_gross_demand(lines: DataFrame, by_week: DataFrame) -> DataFrame:
    """Gross demand per (part, revision, week, type) for weeks >= W0.

    ``by_week`` is ``root_weekly_by_type``. No row of a week is shuffled: the
    parts are dealt before they meet the weeks of their roots.
    """
    one, several = _meet_weeks(_roots_of_parts(lines), by_week)
    key = ["part_number", "revision", "demand_week", "demand_type"]
    amount = F.col("_week_qty") * F.col("_qty")
    return one.select(*key, amount.alias("gross_week_demand")).unionByName(
        several.groupBy(*key).agg(F.sum(amount).alias("gross_week_demand"))
    )


def _consumed(consumption: DataFrame) -> Column:
    """This week's realized consumption matching the demand type."""
    return (
        F.when(F.col("demand_type") == DEMAND_TYPE_PRODUCTION, F.coalesce(F.col("production_consumption"), F.lit(0.0)))
        .when(F.col("demand_type") == DEMAND_TYPE_SPARES, F.coalesce(F.col("nest_consumption"), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def root_weekly_demand(rows: DataFrame, p: ReportParams) -> DataFrame:
    """Demand per (root, revision key, week >= W0), summed over types.

    Also flags whether the root has Production / Spares rows in that week:
    realized consumption is deducted once per type that has a row.
    """
    t = F.col("demand_type")
    return (
        rows.where(F.col("demand_week") >= F.lit(p.week0))
        .groupBy(
            F.col("top_level_bom").alias("_root"),
            text_key(F.col("top_level_revision")).alias("_root_key"),
            "demand_week",
        )
        .agg(
            F.sum("demand_quantity").alias("_week_qty"),
            F.max(F.coalesce(t == DEMAND_TYPE_PRODUCTION, F.lit(False))).alias("_has_production"),
            F.max(F.coalesce(t == DEMAND_TYPE_SPARES, F.lit(False))).alias("_has_spares"),
        )
    )


def weekly_remaining_demand(
    lines: DataFrame, root_weekly: DataFrame, consumption: DataFrame, p: ReportParams
) -> DataFrame:
    """max(gross - realized consumption, 0) per (part, revision, week >= W0).

    Only the current week loses consumption: production consumption if the
    part has Production demand that week, field consumption if it has Spares.
    Computed from per-root weekly totals, so the per-type weekly table (B5)
    is never built. The parts are dealt, and get their consumption, before they
    meet the weeks of their roots, so no row of a week is shuffled.
    """
    parts = _roots_of_parts(lines).join(
        consumption.select("part_number", "production_consumption", "nest_consumption"), "part_number", "left"
    )
    one, several = _meet_weeks(parts, root_weekly)
    key = ["part_number", "revision", "demand_week"]
    gross = F.coalesce(F.col("_week_qty") * F.col("_qty"), F.lit(0.0))
    flags = ["_has_production", "_has_spares"]
    consumed = ["production_consumption", "nest_consumption"]
    g = one.select(*key, gross.alias("_gross"), *flags, *consumed).unionByName(
        several.groupBy(*key).agg(
            F.sum(gross).alias("_gross"),
            *[F.max(c).alias(c) for c in flags],
            *[F.first(c).alias(c) for c in consumed],  # one value a part
        )
    )
    this_week = F.col("demand_week") == F.lit(p.week0)
    used = F.when(
        this_week,
        F.when(F.col("_has_production"), F.coalesce(F.col("production_consumption"), F.lit(0.0))).otherwise(F.lit(0.0))
        + F.when(F.col("_has_spares"), F.coalesce(F.col("nest_consumption"), F.lit(0.0))).otherwise(F.lit(0.0)),
    ).otherwise(F.lit(0.0))
    return g.select(
        *key,
        F.greatest(F.col("_gross") - used, F.lit(0.0)).cast("double").alias("week_demand"),
    )


def last_demand_week(lines: DataFrame, root_weekly: DataFrame) -> DataFrame:
    """Latest demand week >= W0 per (part, revision key), over the part's roots.

    Equal to the latest week of ``weekly_remaining_demand`` for the part, but
    read from the per-root table.
    """
    last = root_weekly.groupBy("_root", "_root_key").agg(F.max("demand_week").alias("_last_week"))
    pr = _part_root_quantity(lines)
    j = pr.join(last, (pr["_line_root"] == last["_root"]) & (pr["_line_key"] == last["_root_key"]))
    return j.groupBy("part_number", text_key(F.col("revision")).alias("revision_key")).agg(
        F.max("_last_week").alias("last_demand_week")
    )


def part_net_demand(gross_by_type: DataFrame, this_week: DataFrame, consumption: DataFrame) -> DataFrame:
    """Net demand per (part, revision): gross minus this week's consumption by type."""
    tw = this_week.select(
        F.col("part_number").alias("_tw_part"), F.col("revision").alias("_tw_rev"), "current_week_gross"
    )
    j = gross_by_type.join(consumption, "part_number", "left").join(
        tw,
        (F.col("part_number") == tw["_tw_part"]) & (text_key(F.col("revision")) == text_key(tw["_tw_rev"])),
        "left",
    )
    cons = _consumed(consumption)
    return j.groupBy("part_number", "revision").agg(
        (F.sum("gross_past8") - F.sum(cons)).alias("net_past8"),
        (F.sum("gross_next8") - F.sum(cons)).alias("net_next8"),
        (F.sum("gross_current") - F.sum(cons)).alias("net_current_week"),
        F.max(F.coalesce(F.col("current_week_gross"), F.lit(0.0))).alias("gross_current_week"),
        F.sum(cons).alias("consumption_current_week"),
    )


def part_net_demand_this_week(net: DataFrame) -> DataFrame:
    """Current-week net demand per part over all revisions."""
    return net.groupBy("part_number").agg(
        F.sum(F.coalesce(F.col("net_current_week"), F.lit(0.0))).alias("current_week_net_demand")
    )
