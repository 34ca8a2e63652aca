"""Queries for operators outside the report's SQL stages.

``alternate_components`` (transitive alternates of the pandas fallback),
``rows_rollup`` (the rollup of report rows that are their own hierarchy),
``direct_parent_on_hand`` (the notebook's stock-in-parent formula),
``plain_path_inline`` (the path normalizer that knows ``PART:REVx`` paths) and
``in_transit_row_objects`` (in-transit stock from shipments that come as one
JSON object a row, with fields that differ from row to row).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kitwise.functions.paths import plain_path_inline
from kitwise.operators import transit
from kitwise.operators.components import alternate_components, direct_parent_on_hand
from kitwise.operators.hierarchy import rollup_of_rows
from kitwise.plans.catalog import shape, stages_for

SCHEMAS = {
    "alternate_components": [("part_number", "string"), ("component", "string"), ("component_size", "bigint")],
    "direct_parent_on_hand": [("path", "string"), ("part_number", "string"), ("direct_parent_on_hand", "double")],
    "in_transit_row_objects": [("part_number", "string"), ("in_transit_quantity", "double")],
    "plain_path_inline": [("path", "string"), ("plain_path", "string")],
    "rows_rollup": [
        ("path", "string"),
        ("part_number", "string"),
        ("top_level_bom", "string"),
        ("total_rolled_up_quantity", "double"),
    ],
}

INLINE_SEGMENT = r"\|([A-Za-z][A-Za-z0-9]{0,2})\|"


def _alternate_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stages_for(spark, sf_dir, "table")
    rows = st.spine.join(st.alternates_text, "part_number", "left")
    return shape(alternate_components(rows), SCHEMAS["alternate_components"])


def _direct_parent_on_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rows are read three times; what they are made of, once
    st = stages_for(spark, sf_dir, "table", hot=("spine", "inventory_by_part"))
    rows = st.spine.join(st.inventory_by_part.select("part_number", "on_hand"), "part_number", "left")
    return shape(direct_parent_on_hand(rows), SCHEMAS["direct_parent_on_hand"])


def _plain_path_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    bom = stages_for(spark, sf_dir).i.bom
    # Each path as stored, and rewritten to the inline form PART:REVx.
    inline = F.regexp_replace(F.col("path"), INLINE_SEGMENT, ":REV$1|")
    paths = bom.select("path").unionAll(bom.select(inline.alias("path")))
    out = paths.select("path", plain_path_inline(F.col("path")).alias("plain_path"))
    return shape(out, SCHEMAS["plain_path_inline"])


def _rows_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stages_for(spark, sf_dir)
    return shape(rollup_of_rows(st.spine, st.p), SCHEMAS["rows_rollup"])


def _as_objects(df: DataFrame, other_names: dict[str, str]) -> DataFrame:
    """Each row as JSON text; about half of the rows have other field names, in upper case."""
    plain = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    renamed = F.to_json(F.struct(*[F.col(c).alias(other_names.get(c, c).upper()) for c in df.columns]))
    return df.select(F.when(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == 0, plain).otherwise(renamed).alias("payload"))


def _in_transit_row_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stages_for(spark, sf_dir)
    p = replace(st.p, shipments=replace(st.p.shipments, row_object="payload"))
    ships = _as_objects(st.i.shipments, {"shipment_id": "id", "state": "shipment_status", "updated_at": "write_date"})
    lines = _as_objects(st.i.shipment_lines, {"default_code": "odoo_part_code", "quantity": "product_uom_qty"})
    rows = transit.shipment_lines(lines, transit.latest_shipments(ships, p), p)
    return shape(transit.in_transit(rows, p), SCHEMAS["in_transit_row_objects"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "alternate_components": _alternate_components,
        "direct_parent_on_hand": _direct_parent_on_hand,
        "in_transit_row_objects": _in_transit_row_objects,
        "plain_path_inline": _plain_path_inline,
        "rows_rollup": _rows_rollup,
    }
