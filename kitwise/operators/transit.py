"""In-transit stock (stages H1-H4).

Shipment sources are loosely typed and their column names drift; values are
read from the first candidate column that exists and parses
(``kitwise.sources.drift``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kitwise.functions.text import normalize_status
from kitwise.sources.drift import first_parsed, first_text, with_row_object
from kitwise.params import ReportParams


def latest_shipments(shipments: DataFrame, p: ReportParams) -> DataFrame:
    """H1: latest row per shipment and its normalized status ('' if none)."""
    f = p.shipments
    shipments = with_row_object(shipments, f.row_object)
    rows = shipments.select(
        first_text(shipments, f.id_candidates, f.row_object).alias("shipment_id"),
        first_text(shipments, (f.configured_status, *f.status_candidates), f.row_object).alias("_raw_status"),
        first_parsed(shipments, f.updated_candidates, "timestamp_ntz", f.row_object).alias("_updated"),
    ).where(F.col("shipment_id").isNotNull())
    w = Window.partitionBy("shipment_id").orderBy(F.col("_updated").desc_nulls_last(), F.col("_raw_status").asc_nulls_last())
    return (
        rows.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("shipment_id", normalize_status(F.col("_raw_status")).alias("shipment_status"))
    )


def shipment_lines(lines: DataFrame, latest: DataFrame, p: ReportParams) -> DataFrame:
    """H2: part and quantity of each shipment line (0 if none parses), with status."""
    f = p.shipments
    lines = with_row_object(lines, f.row_object)
    quantity = first_parsed(lines, (f.configured_quantity, *f.quantity_candidates), "double", f.row_object)
    rows = lines.select(
        first_text(lines, (f.configured_part, *f.part_candidates), f.row_object).alias("part_number"),
        F.coalesce(quantity, F.lit(0.0)).alias("quantity"),
        first_text(lines, (f.line_shipment_id,), f.row_object).alias("_shipment_id"),
    )
    return rows.join(latest, rows["_shipment_id"] == latest["shipment_id"]).select(
        "part_number", "quantity", "shipment_status"
    )


def in_transit(lines: DataFrame, p: ReportParams) -> DataFrame:
    """H3: quantity per part on shipments that are not finished."""
    return (
        lines.where(F.col("part_number").isNotNull() & ~F.col("shipment_status").isin(*p.terminal_statuses))
        .groupBy("part_number")
        .agg(F.sum("quantity").cast("double").alias("in_transit_quantity"))
    )


def in_transit_alt(base: DataFrame, transit: DataFrame, directed: DataFrame) -> DataFrame:
    """H4: own in-transit plus positive in-transit of directed alternates.

    Only a group's first part (the original) collects its alternates'.
    """
    own = transit.select("part_number", F.col("in_transit_quantity").alias("_own"))
    alt = (
        directed.where(F.col("related_part_number") != F.col("base_part_number"))
        .join(
            transit.where(F.col("in_transit_quantity") > 0),
            F.col("related_part_number") == transit["part_number"],
        )
        .groupBy(F.col("base_part_number").alias("part_number"))
        .agg(F.sum("in_transit_quantity").alias("_alts"))
    )
    j = base.select("part_number").join(own, "part_number", "left").join(alt, "part_number", "left")
    return j.select(
        "part_number",
        (F.coalesce(F.col("_own"), F.lit(0.0)) + F.coalesce(F.col("_alts"), F.lit(0.0)))
        .cast("double")
        .alias("in_transit_alt"),
    )
