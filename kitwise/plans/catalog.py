"""Registered queries: one per report stage, over the stand-in inputs.

Each entry names a stage of ``ReportStages`` and declares its output schema.
The Spark side casts to that schema and rounds doubles to ``ROUND_DIGITS``
(sums of fractions differ in the last bits with summation order); the DuckDB
oracle in ``oracle/`` casts and rounds the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kitwise.operators.report import PUBLISHED_COLUMNS
from kitwise.plans.stages import HOT_STAGES, ReportStages
from kitwise.sources import standins

ROUND_DIGITS = 4

_S = "string"
_D = "double"
_I = "int"
_B = "bigint"
_DT = "date"
_TS = "timestamp_ntz"

LINE_SCHEMA = [
    ("path", _S),
    ("part_number", _S),
    ("revision", _S),
    ("product_name", _S),
    ("production_state", _S),
    ("indent_level", _I),
    ("uom", _S),
    ("tracking", _S),
    ("is_consumable_storable", _S),
    ("parent_bom", _S),
    ("parent_revision", _S),
    ("top_level_bom", _S),
    ("top_level_revision", _S),
    ("quantity", _D),
    ("procurement_intent", _S),
    ("adjusted_quantity", _D),
    ("adjusted_procurement_intent", _S),
    ("global_alternate_part_numbers", _S),
    ("substitute_part_numbers", _S),
    ("path_without_revision", _S),
]

_RAW_TEXT = {
    "alternates_text",
    "latest_po",
    "latest_supplier",
    "unit_cost_source",
    "product",
    "variant",
    "system",
    "subsystem",
    "commodity",
    "inventory_status",
    "supply_plan_status",
    "shipments_status",
}

REPORT_RAW_COLUMNS = [
    c
    for c in (
        "total_rolled_up_quantity",
        "alternates_text",
        "latest_po",
        "latest_supplier",
        "latest_po_created_at",
        "unit_cost",
        "unit_cost_source",
        "product",
        "variant",
        "system",
        "subsystem",
        "commodity",
        "gross_past8",
        "net_past8",
        "gross_current_week",
        "net_current_week",
        "consumption_current_week",
        "gross_next8",
        "net_next8",
        "received_avg_4w",
        "received_avg_8w",
        "received_rate_since_last",
        "received_avg_4w_alt",
        "received_avg_8w_alt",
        "received_rate_since_last_alt",
        "on_hand",
        "receiving",
        "on_hand_in_parents",
        "on_hand_in_alt_parents",
        "in_transit_in_alt_parents",
        "in_transit_alt",
        "in_transit_value_alt",
        "on_hand_delta",
        "quarantine",
        "on_hand_alt",
        "receiving_alt",
        "weeks_of_stock",
        "weeks_of_stock_with_in_transit",
        "in_transit_weeks_of_stock",
        "system_min_in_transit_weeks",
        "on_hand_with_alt_and_parents",
        "on_hand_value_with_alt_and_parents",
        "sets_alt",
        "sets_receiving",
        "sets_of_alt_parents",
        "sets_with_in_transit_of_alt_parents",
        "sets_alt_and_parents",
        "sets_with_in_transit",
        "quarantine_alt",
        "current_week_supply",
        "plan_total_4w",
        "plan_total_8w",
        "plan_avg_4w",
        "plan_avg_8w",
        "current_week_supply_alt",
        "plan_total_4w_alt",
        "plan_total_8w_alt",
        "plan_avg_4w_alt",
        "plan_avg_8w_alt",
        "inventory_status",
        "supply_plan_status",
        "shipments_status",
    )
]


def _raw_type(c: str) -> str:
    if c in _RAW_TEXT:
        return _S
    if c == "latest_po_created_at":
        return _TS
    return _D


def _published_type(src: str) -> str:
    for name, t in LINE_SCHEMA:
        if name == src:
            return t
    return _raw_type(src)


REPORT_RAW_SCHEMA = LINE_SCHEMA + [(c, _raw_type(c)) for c in REPORT_RAW_COLUMNS]
REPORT_FINAL_SCHEMA = [(name, _D if zero else _published_type(src)) for name, src, zero in PUBLISHED_COLUMNS]

# name -> (stage attribute, output schema)
QUERIES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    # A
    "eligible_roots": ("eligible_roots", [("part_number", _S), ("revision", _S)]),
    "child_parts": ("child_parts", [("part_number", _S)]),
    "demanded_roots": ("demanded_roots", [("part_number", _S), ("revision", _S)]),
    "scoped_bom_plain_path": ("lines", LINE_SCHEMA),
    "part_root_rollup": (
        "part_root_rollup",
        [("part_number", _S), ("top_level_bom", _S), ("top_level_revision", _S), ("total_rolled_up_quantity", _D)],
    ),
    "part_rollup_max": ("part_rollup", [("part_number", _S), ("total_rolled_up_quantity", _D)]),
    "assembly_root_rollup": (
        "assembly_root_rollup",
        [("parent_part_number", _S), ("top_level_bom", _S), ("top_level_revision", _S), ("parent_rolled_up_quantity", _D)],
    ),
    "ancestor_usage": (
        "ancestor_usage",
        [
            ("path", _S),
            ("parent_part_number", _S),
            ("top_level_bom", _S),
            ("top_level_revision", _S),
            ("child_quantity_in_parent", _D),
        ],
    ),
    # B
    "demand_rows": (
        "demand_rows",
        [
            ("top_level_bom", _S),
            ("top_level_revision", _S),
            ("demand_quantity", _D),
            ("demand_type", _S),
            ("demand_date", _DT),
            ("demand_week", _DT),
        ],
    ),
    "line_gross_demand": (
        "line_gross_demand",
        [
            ("path", _S),
            ("part_number", _S),
            ("revision", _S),
            ("gross_past8", _D),
            ("gross_next4", _D),
            ("gross_next8", _D),
        ],
    ),
    "part_gross_demand_by_type": (
        "part_gross_demand_by_type",
        [
            ("part_number", _S),
            ("revision", _S),
            ("demand_type", _S),
            ("gross_past8", _D),
            ("gross_next8", _D),
            ("gross_current", _D),
        ],
    ),
    "part_gross_demand_this_week": (
        "part_gross_demand_this_week",
        [("part_number", _S), ("revision", _S), ("current_week_gross", _D)],
    ),
    "weekly_gross_demand": (
        "weekly_gross_demand",
        [("part_number", _S), ("revision", _S), ("demand_week", _DT), ("demand_type", _S), ("gross_week_demand", _D)],
    ),
    "weekly_remaining_demand": (
        "weekly_remaining_demand",
        [("part_number", _S), ("revision", _S), ("demand_week", _DT), ("week_demand", _D)],
    ),
    "part_net_demand": (
        "part_net_demand",
        [
            ("part_number", _S),
            ("revision", _S),
            ("net_past8", _D),
            ("net_next8", _D),
            ("net_current_week", _D),
            ("gross_current_week", _D),
            ("consumption_current_week", _D),
        ],
    ),
    "part_net_demand_this_week": (
        "part_net_demand_this_week",
        [("part_number", _S), ("current_week_net_demand", _D)],
    ),
    # C
    "bom_enriched": (
        "spine",
        LINE_SCHEMA
        + [("product", _S), ("variant", _S), ("system", _S), ("subsystem", _S), ("commodity", _S)],
    ),
    "report_parts": ("report_parts", [("part_number", _S)]),
    # D
    "alternate_groups": ("groups", [("group_id", _B), ("part_index", _I), ("part_number", _S)]),
    "directed_bridge": ("directed_bridge", [("base_part_number", _S), ("related_part_number", _S)]),
    "alternate_bridge": ("alternate_bridge", [("base_part_number", _S), ("related_part_number", _S)]),
    "alternates_text": ("alternates_text", [("part_number", _S), ("alternates_text", _S)]),
    # E
    "po_line_latest": (
        "po_line_latest",
        [
            ("id", _B),
            ("purchase_order_number", _S),
            ("line_number", _I),
            ("po_created_at", _TS),
            ("part_number", _S),
            ("supplier_name", _S),
            ("revision", _S),
            ("unit_price", _D),
            ("uom_factor", _D),
            ("unit_cost", _D),
        ],
    ),
    "latest_po": (
        "latest_po",
        [
            ("part_number", _S),
            ("revision", _S),
            ("latest_po", _S),
            ("latest_supplier", _S),
            ("latest_po_created_at", _TS),
            ("unit_cost", _D),
        ],
    ),
    "latest_part_cost": ("latest_part_cost", [("part_number", _S), ("unit_cost", _D)]),
    "forecast_cost": ("forecast_cost", [("part_number", _S), ("unit_cost", _D)]),
    "part_cost": ("part_cost", [("part_number", _S), ("unit_cost", _D), ("unit_cost_source", _S)]),
    # F
    "location_category": ("location_category", [("id", _B), ("complete_name", _S), ("category", _S)]),
    "move_category": (
        "moves",
        [
            ("date", _TS),
            ("part_number", _S),
            ("name", _S),
            ("product_qty", _D),
            ("origin_category", _S),
            ("destination_category", _S),
            ("movement_category", _S),
            ("movement_quantity", _D),
        ],
    ),
    "receipts": ("receipts", [("part_number", _S), ("date", _TS), ("receipt_week", _DT), ("quantity", _D)]),
    "supply_this_week": ("supply_this_week", [("part_number", _S), ("current_week_supply", _D)]),
    "consumption_this_week": (
        "consumption_this_week",
        [("part_number", _S), ("production_consumption", _D), ("nest_consumption", _D)],
    ),
    "receipt_rates": (
        "receipt_rates",
        [("part_number", _S), ("received_avg_4w", _D), ("received_avg_8w", _D), ("received_rate_since_last", _D)],
    ),
    "latest_receipt_alt": ("latest_receipt_alt", [("part_number", _S), ("date", _TS), ("quantity", _D)]),
    "receipt_rates_alt": (
        "receipt_rates_alt",
        [
            ("part_number", _S),
            ("received_avg_4w_alt", _D),
            ("received_avg_8w_alt", _D),
            ("received_rate_since_last_alt", _D),
        ],
    ),
    "supply_this_week_alt": ("supply_this_week_alt", [("part_number", _S), ("current_week_supply_alt", _D)]),
    # G
    "inventory_by_part": (
        "inventory_by_part",
        [("part_number", _S), ("on_hand", _D), ("on_hand_value", _D), ("receiving", _D), ("quarantine", _D)],
    ),
    "inventory_alt": (
        "inventory_alt",
        [
            ("part_number", _S),
            ("on_hand_alt", _D),
            ("on_hand_value_alt", _D),
            ("receiving_alt", _D),
            ("quarantine_alt", _D),
        ],
    ),
    # H
    "latest_shipments": ("latest_shipments", [("shipment_id", _S), ("shipment_status", _S)]),
    "shipment_lines": ("shipment_lines", [("part_number", _S), ("quantity", _D), ("shipment_status", _S)]),
    "in_transit": ("in_transit", [("part_number", _S), ("in_transit_quantity", _D)]),
    "in_transit_alt": ("in_transit_alt", [("part_number", _S), ("in_transit_alt", _D)]),
    # I
    "parent_alternate_candidates": (
        "parent_alternate_candidates",
        [
            ("path", _S),
            ("parent_part_number", _S),
            ("child_quantity_in_parent", _D),
            ("alternate_parent_part_number", _S),
        ],
    ),
    "alt_parent_latest_rev": (
        "alt_parent_latest_rev",
        [("alternate_parent_part_number", _S), ("top_level_revision", _S)],
    ),
    "alt_parent_requirements": (
        "alt_parent_requirements",
        [("alternate_parent_part_number", _S), ("component_part_number", _S), ("component_required_quantity", _D)],
    ),
    "alt_component_supply": (
        "alt_component_supply",
        [("component_part_number", _S), ("available_on_hand", _D), ("available_with_in_transit", _D)],
    ),
    "buildable_sets": (
        "buildable_sets",
        [("alternate_parent_part_number", _S), ("sets_on_hand", _D), ("sets_with_in_transit", _D)],
    ),
    "line_parent_alternates": (
        "line_parent_alternates",
        [
            ("path", _S),
            ("on_hand_in_alt_parents", _D),
            ("in_transit_in_alt_parents", _D),
            ("sets_of_alt_parents", _D),
            ("sets_with_in_transit_of_alt_parents", _D),
        ],
    ),
    "line_parent_stock": (
        "line_parent_stock",
        [("path", _S), ("on_hand_in_parents", _D), ("sets_in_parents", _D), ("valid_parent_count", _B)],
    ),
    # J
    "demand_horizon": (
        "demand_horizon",
        [("path", _S), ("part_number", _S), ("revision", _S), ("max_week_offset", _I)],
    ),
    "weekly_stock_position": (
        "weekly_coverage",
        [
            ("path", _S),
            ("part_number", _S),
            ("revision", _S),
            ("week_offset", _I),
            ("demand_week", _DT),
            ("week_demand", _D),
            ("stock", _D),
            ("stock_with_in_transit", _D),
            ("in_transit", _D),
            ("prior_demand", _D),
        ],
    ),
    "weekly_coverage": (
        "weekly_coverage",
        [
            ("path", _S),
            ("part_number", _S),
            ("revision", _S),
            ("week_offset", _I),
            ("week_demand", _D),
            ("prior_demand", _D),
            ("week_coverage", _D),
            ("week_coverage_with_in_transit", _D),
            ("week_coverage_in_transit", _D),
        ],
    ),
    "weeks_of_stock": (
        "weeks_of_stock",
        [
            ("path", _S),
            ("part_number", _S),
            ("revision", _S),
            ("weeks_of_stock", _D),
            ("weeks_of_stock_with_in_transit", _D),
            ("in_transit_weeks_of_stock", _D),
        ],
    ),
    "system_alternate_lines": ("system_alternate_lines", [("path", _S)]),
    "system_min_weeks": (
        "system_min_weeks",
        [("top_level_bom", _S), ("top_level_revision", _S), ("system_group", _S), ("system_min_in_transit_weeks", _D)],
    ),
    # K
    "supply_plan_rows": (
        "supply_plan_rows",
        [("part_number", _S), ("quantity", _D), ("plan_date", _DT), ("plan_week", _DT)],
    ),
    "supply_plan": (
        "supply_plan",
        [
            ("part_number", _S),
            ("current_week_supply", _D),
            ("plan_total_4w", _D),
            ("plan_total_8w", _D),
            ("plan_avg_4w", _D),
            ("plan_avg_8w", _D),
        ],
    ),
    "supply_plan_alt": (
        "supply_plan_alt",
        [
            ("part_number", _S),
            ("current_week_supply_alt", _D),
            ("plan_total_4w_alt", _D),
            ("plan_total_8w_alt", _D),
            ("plan_avg_4w_alt", _D),
            ("plan_avg_8w_alt", _D),
        ],
    ),
    # L
    "report_raw": ("report_raw", REPORT_RAW_SCHEMA),
    "report_final": ("report_final", REPORT_FINAL_SCHEMA),
    "report_statuses": (
        "report_raw",
        [
            ("path", _S),
            ("part_number", _S),
            ("revision", _S),
            ("weeks_of_stock", _D),
            ("inventory_status", _S),
            ("supply_plan_status", _S),
            ("shipments_status", _S),
        ],
    ),
}


def shape(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Select ``schema``'s columns in order, cast, doubles rounded."""
    cols = []
    for name, t in schema:
        c = F.col(f"`{name}`").cast(t)
        if t == "double":
            c = F.round(c, ROUND_DIGITS)
        cols.append(c.alias(name))
    return df.select(*cols)


# Queries over the whole stage graph write its shared stages once on first
# use; a single stage reads each shared stage once or twice, so it stays one
# plan.
MATERIALIZED = {"report_raw", "report_final", "report_statuses"}


def stages_for(
    spark: SparkSession, sf_dir: str, materialize: str | None = None, hot: Sequence[str] = HOT_STAGES
) -> ReportStages:
    """Stage graph over the stand-ins."""
    return ReportStages(standins.load(spark, sf_dir), standins.PARAMS, materialize=materialize, hot=hot)


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    stage, schema = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        st = stages_for(spark, sf_dir, "table" if name in MATERIALIZED else None)
        return shape(getattr(st, stage), schema)

    run.__name__ = name
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query(name) for name in QUERIES}
