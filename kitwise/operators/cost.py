"""Purchasing cost (stages E1-E6).

Top-1-per-group stages use ``row_number() == 1``; Spark plans these as a
``WindowGroupLimit`` that also runs before the shuffle, so a hot key does not
ship all its rows to one task. NULL placement is spelled out: the report's
warehouse puts NULLs first on descending keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kitwise.functions.text import text_key
from kitwise.params import UNIT_PRICE_DIVISOR, ReportParams

PO_LINE_COLUMNS = (
    "id",
    "purchase_order_number",
    "line_number",
    "po_created_at",
    "part_number",
    "supplier_name",
    "revision",
    "unit_price",
    "uom_factor",
    "unit_cost",
)


def po_line_versions(
    po_line: DataFrame,
    po_version: DataFrame,
    purchase_order: DataFrame,
    product_template: DataFrame,
    supplier: DataFrame,
    uom: DataFrame,
    uom_factor: DataFrame,
    newest_only: bool = False,
) -> DataFrame:
    """Issued purchase lines with unit cost and a version rank.

    Orders are put together with their versions, and factors with their units,
    before they meet the lines, so lines are moved once a key.

    With ``newest_only`` the lines that cannot be the newest of their part are
    left out once they have their order: of each template and unit only the
    newest stay, ties included. Such lines have the same parts and factors, so
    E4 finds the same line of each part, while the lookups meet few rows.
    """
    pov = po_version.where(F.col("status") == "ISSUED").alias("pov")
    po = purchase_order.alias("po")
    sup = supplier.alias("sup")
    orders = (
        pov.join(po, F.col("pov.purchase_order_id") == F.col("po.id"), "left")
        .join(sup, F.col("sup.id") == F.col("pov.supplier_id"), "left")
        .select(F.col("pov.id").alias("_version"), "purchase_order_number", F.col("sup.name").alias("supplier_name"))
    )
    zu = uom.alias("zu")
    uf = uom_factor.alias("uf")
    units = zu.join(uf, F.col("zu.unit_ref_id") == F.col("uf.id"), "left").select(F.col("zu.id").alias("_unit"), "factor")
    pt = product_template.where(F.col("default_code").isNotNull()).select(F.col("id").alias("_template"), "default_code")
    lines = po_line.withColumnRenamed("created_at", "po_created_at")
    lines = lines.join(orders, F.col("purchase_order_version_id") == F.col("_version"))
    if newest_only:
        w = Window.partitionBy("part_template_id", "unit_of_measure_id").orderBy(*_newest_first()[:-1])
        lines = lines.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") == 1)
    j = lines.join(pt, F.col("part_template_id") == F.col("_template")).join(
        units, F.col("unit_of_measure_id") == F.col("_unit"), "left"
    )
    price = F.col("unit_price_ucents") / F.lit(UNIT_PRICE_DIVISOR)
    factor = F.col("factor")
    rows = j.select(
        "id",
        "purchase_order_number",
        "line_number",
        "po_created_at",
        F.col("default_code").alias("part_number"),
        "supplier_name",
        F.col("major_revision_name").alias("revision"),
        price.alias("unit_price"),
        factor.alias("uom_factor"),
        F.when(factor.isNull(), price).otherwise(price * factor).alias("unit_cost"),
    )
    w = Window.partitionBy("purchase_order_number", "line_number", "part_number").orderBy(
        F.col("po_created_at").desc_nulls_first(),
        F.col("id").desc_nulls_first(),
        F.col("unit_cost").desc_nulls_first(),
    )
    return rows.withColumn("line_version_rn", F.row_number().over(w))


def po_line_latest(versions: DataFrame) -> DataFrame:
    """Newest version of each purchase line."""
    return versions.where(F.col("line_version_rn") == 1).select(*PO_LINE_COLUMNS)


def _newest_first():
    return (
        F.col("po_created_at").desc_nulls_first(),
        F.col("purchase_order_number").desc_nulls_first(),
        F.col("line_number").desc_nulls_first(),
        F.col("id").desc_nulls_first(),
        F.col("unit_cost").desc_nulls_first(),
    )


def latest_po(lines: DataFrame) -> DataFrame:
    """Newest issued line per (part, revision key): PO, supplier, date, cost."""
    w = Window.partitionBy("part_number", text_key(F.col("revision"))).orderBy(*_newest_first())
    return (
        lines.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(
            "part_number",
            "revision",
            F.col("purchase_order_number").alias("latest_po"),
            F.col("supplier_name").alias("latest_supplier"),
            F.col("po_created_at").alias("latest_po_created_at"),
            "unit_cost",
        )
    )


def latest_part_cost(lines: DataFrame) -> DataFrame:
    """Unit cost of the newest issued line per part."""
    w = Window.partitionBy("part_number").orderBy(*_newest_first())
    return (
        lines.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("part_number", "unit_cost")
    )


def forecast_cost(sheet: DataFrame, p: ReportParams) -> DataFrame:
    """E5: newest non-NULL forecast cost per trimmed part number."""
    cost, synced = p.columns.forecast_cost, p.columns.forecast_synced
    part = F.nullif(F.trim(F.col("part_number")), F.lit(""))
    rows = sheet.select(part.alias("part_number"), F.col(cost).cast("double").alias("unit_cost"), F.col(synced).alias("_synced"))
    rows = rows.where(F.col("part_number").isNotNull() & F.col("unit_cost").isNotNull())
    w = Window.partitionBy("part_number").orderBy(F.col("_synced").desc_nulls_last(), F.col("unit_cost").desc_nulls_last())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select("part_number", "unit_cost")


def part_cost(po_cost: DataFrame, forecast: DataFrame, p: ReportParams) -> DataFrame:
    """PO cost unless missing or 0, else forecast; with the source label."""
    zp = po_cost.select(F.col("part_number").alias("_zp_part"), F.col("unit_cost").alias("_zp_cost"))
    fc = forecast.select(F.col("part_number").alias("_fc_part"), F.col("unit_cost").alias("_fc_cost"))
    j = zp.join(fc, zp["_zp_part"] == fc["_fc_part"], "full")
    po_ok = F.nullif(F.col("_zp_cost"), F.lit(0.0))
    return j.select(
        F.coalesce(F.col("_zp_part"), F.col("_fc_part")).alias("part_number"),
        F.coalesce(po_ok, F.col("_fc_cost")).alias("unit_cost"),
        F.when(po_ok.isNotNull(), F.lit(p.po_cost_label))
        .when(F.col("_fc_cost").isNotNull(), F.lit(p.forecast_cost_label))
        .alias("unit_cost_source"),
    )
