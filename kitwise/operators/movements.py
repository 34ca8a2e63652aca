"""Stock movements (stages F1-F9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.functions.dates import days_between, week_start
from kitwise.functions.rules import classify_by_rules, movement_category, movement_quantity
from kitwise.operators.alternates import latest_over_alternates
from kitwise.params import NEST_CONSUMPTION, PRODUCTION_CONSUMPTION, RECEIPT_CATEGORIES, ReportParams


def location_category(locations: DataFrame, p: ReportParams) -> DataFrame:
    """location id to category by the ordered LIKE rules."""
    return locations.select(
        "id",
        "complete_name",
        classify_by_rules(F.col("complete_name"), p.location_rules, p.unknown_category).alias("category"),
    )


def classify_moves(
    moves: DataFrame,
    product_product: DataFrame,
    product_template: DataFrame,
    categories: DataFrame,
    p: ReportParams,
) -> DataFrame:
    """done moves since the cutoff with part, categories and signed quantity.

    Products get their templates first and moves their categories, so moves are
    dealt once, by product.
    """
    sm = moves.where((F.col("state") == "done") & (F.col("date") >= F.lit(p.since)))
    pp = product_product.select(F.col("id").alias("_pp_id"), F.col("product_tmpl_id").alias("_tmpl"))
    pt = product_template.select(F.col("id").alias("_pt_id"), "default_code", "name")
    products = pp.join(pt, pp["_tmpl"] == pt["_pt_id"], "left").select("_pp_id", "default_code", "name")
    org = categories.select(F.col("id").alias("_o_id"), F.col("category").alias("origin_category"))
    dst = categories.select(F.col("id").alias("_d_id"), F.col("category").alias("destination_category"))
    o, d = F.col("origin_category"), F.col("destination_category")
    categorized = (
        sm.join(org, org["_o_id"] == sm["location_id"], "left")
        .join(dst, dst["_d_id"] == sm["location_dest_id"], "left")
        .select(
            "date",
            "product_id",
            "product_qty",
            o,
            d,
            movement_category(o, d).alias("movement_category"),
            movement_quantity(o, d, F.col("product_qty")).alias("movement_quantity"),
        )
    )
    return categorized.join(products, F.col("product_id") == F.col("_pp_id"), "left").select(
        "date",
        F.col("default_code").alias("part_number"),
        "name",
        "product_qty",
        "origin_category",
        "destination_category",
        "movement_category",
        "movement_quantity",
    )


def receipts(moves: DataFrame) -> DataFrame:
    """supply receipts with a quantity, and their week."""
    return moves.where(
        F.col("movement_category").isin(*RECEIPT_CATEGORIES) & F.col("movement_quantity").isNotNull()
    ).select("part_number", "date", week_start(F.col("date")).alias("receipt_week"), F.col("movement_quantity").alias("quantity"))


def supply_this_week(rcpts: DataFrame, p: ReportParams) -> DataFrame:
    """quantity received in the as-of week per part (0 for other parts with receipts)."""
    return rcpts.groupBy("part_number").agg(
        F.sum(F.when(F.col("receipt_week") == F.lit(p.week0), F.col("quantity")).otherwise(F.lit(0.0))).alias(
            "current_week_supply"
        )
    )


def consumption_this_week(moves: DataFrame, p: ReportParams) -> DataFrame:
    """production and field consumption in the as-of week per part."""
    this_week = week_start(F.col("date")) == F.lit(p.week0)
    q = F.col("movement_quantity")
    cat = F.col("movement_category")
    return moves.groupBy("part_number").agg(
        F.sum(F.when(this_week & (cat == PRODUCTION_CONSUMPTION), q).otherwise(F.lit(0.0))).alias(
            "production_consumption"
        ),
        F.sum(F.when(this_week & (cat == NEST_CONSUMPTION), q).otherwise(F.lit(0.0))).alias("nest_consumption"),
    )


def receipt_window_sums(rcpts: DataFrame, p: ReportParams) -> DataFrame:
    """Per part: received in the last 4 and 8 weeks, and the latest receipt."""
    w = F.col("receipt_week")
    q = F.col("quantity")
    in4 = (w >= F.lit(p.week(-3))) & (w <= F.lit(p.week0))
    in8 = (w >= F.lit(p.week(-7))) & (w <= F.lit(p.week0))
    return rcpts.groupBy("part_number").agg(
        F.sum(F.when(in4, q).otherwise(F.lit(0.0))).alias("received_4w"),
        F.sum(F.when(in8, q).otherwise(F.lit(0.0))).alias("received_8w"),
        # Latest receipt: date first, larger quantity on a tie.
        F.max(F.struct(F.col("date").alias("date"), q.alias("quantity"))).alias("latest"),
    )


def _rate_since(latest_date, latest_qty, p: ReportParams):
    """Quantity of the last receipt per week since it; NULL on the as-of day."""
    weeks = days_between(latest_date, p.as_of) / F.lit(7.0)
    return latest_qty / F.nullif(weeks, F.lit(0.0))


def receipt_rates(rcpts: DataFrame, p: ReportParams) -> DataFrame:
    """4- and 8-week receipt averages and the rate since the last receipt."""
    s = receipt_window_sums(rcpts, p)
    return s.select(
        "part_number",
        (F.col("received_4w") / F.lit(4.0)).alias("received_avg_4w"),
        (F.col("received_8w") / F.lit(8.0)).alias("received_avg_8w"),
        _rate_since(F.col("latest.date"), F.col("latest.quantity"), p).alias("received_rate_since_last"),
    )


def latest_receipt_alt(base: DataFrame, groups: DataFrame, rcpts: DataFrame, p: ReportParams) -> DataFrame:
    """latest receipt (date, quantity) over each part's related parts."""
    per_part = receipt_window_sums(rcpts, p).select("part_number", "latest")
    latest = latest_over_alternates(base, groups, per_part, "latest")
    return latest.select("part_number", F.col("latest.date").alias("date"), F.col("latest.quantity").alias("quantity"))


def receipt_rates_alt(base: DataFrame, alt_sums: DataFrame, latest_alt: DataFrame, p: ReportParams) -> DataFrame:
    """F8: F6 over each part's related parts; no receipts gives 0, 0 and NULL.

    ``alt_sums`` holds ``received_4w`` / ``received_8w`` summed over related
    parts (``alternate_sums``), ``latest_alt`` is F7.
    """
    j = base.select("part_number").join(alt_sums, "part_number", "left").join(latest_alt, "part_number", "left")
    return j.select(
        "part_number",
        (F.coalesce(F.col("received_4w"), F.lit(0.0)) / F.lit(4.0)).alias("received_avg_4w_alt"),
        (F.coalesce(F.col("received_8w"), F.lit(0.0)) / F.lit(8.0)).alias("received_avg_8w_alt"),
        _rate_since(F.col("date"), F.col("quantity"), p).alias("received_rate_since_last_alt"),
    )


def supply_this_week_alt(alt_sums: DataFrame) -> DataFrame:
    """F4 summed over each part's related parts."""
    return alt_sums.select("part_number", F.col("current_week_supply").alias("current_week_supply_alt"))
