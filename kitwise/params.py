"""Report parameters: one frozen dataclass handed to every stage.

Everything the report treats as a constant (as-of date, movement cutoff,
horizon, buy intent, location rules, source column names) lives here so the
stages stay pure functions of their input frames.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the report's own values for equal results.
# ---------------------------------------------------------------------------

# Location categories.
VENDORS = "Vendors"
PRODUCTION = "Production"
WAREHOUSE = "Warehouse"
RECEIVING = "Receiving & Pre-IQC"
QUARANTINE = "Quarantine"
SCRAP = "Scrap"
NEST = "Nest"
RND = "R&D"
UNKNOWN = "Unknown"

# Categories that count as stock on hand.
STOCK_CATEGORIES = (WAREHOUSE, RECEIVING)

# Movement categories.
NEW_SUPPLY = "New Supply"
NEST_CONSUMPTION = "Nest Consumption"
RMA_SUPPLY = "RMA Supply"
PRODUCTION_CONSUMPTION = "Production Consumption"
QC_LOSS_CONSUMPTION = "QC Loss Consumption"
RND_CONSUMPTION = "R&D Consumption"
RND_SUPPLY = "R&D Supply"

# Movement rules, first match wins: (origin, destination, category, sign).
# "stock" stands for any of STOCK_CATEGORIES.
MOVEMENT_RULES = (
    (VENDORS, "stock", NEW_SUPPLY, 1),
    ("stock", VENDORS, NEW_SUPPLY, -1),
    ("stock", NEST, NEST_CONSUMPTION, 1),
    (NEST, "stock", RMA_SUPPLY, 1),
    ("stock", PRODUCTION, PRODUCTION_CONSUMPTION, 1),
    (PRODUCTION, "stock", PRODUCTION_CONSUMPTION, -1),
    ("stock", SCRAP, QC_LOSS_CONSUMPTION, 1),
    ("stock", QUARANTINE, QC_LOSS_CONSUMPTION, 1),
    (QUARANTINE, "stock", QC_LOSS_CONSUMPTION, -1),
    (SCRAP, "stock", QC_LOSS_CONSUMPTION, -1),
    ("stock", RND, RND_CONSUMPTION, 1),
    (RND, "stock", RND_SUPPLY, 1),
)
RECEIPT_CATEGORIES = (NEW_SUPPLY, RND_SUPPLY)

# Demand types that realized consumption is deducted from.
DEMAND_TYPE_PRODUCTION = "Production"
DEMAND_TYPE_SPARES = "Spares"

# Shipment statuses (after normalization) that are no longer in transit.
TERMINAL_SHIPMENT_STATUSES = (
    "DRAFT",
    "CANCELED",
    "CANCELLED",
    "DELIVERED",
    "DELIVERED_COMPLETED",
    "COMPLETE",
    "COMPLETED",
    "DONE",
)

# Revision segment inside a hierarchy path: a pipe, a letter, up to two
# letters or digits, a pipe.
REVISION_SEGMENT_PATTERN = "[|][A-Za-z][A-Za-z0-9]{0,2}[|]"
INLINE_REVISION_PATTERN = ":REV[A-Za-z0-9]+"

# Unit price is stored in millionths of a cent.
UNIT_PRICE_DIVISOR = 100000000.0

# Default labels of a unit cost's source.
COST_SOURCE_PO = "latest_purchase_order"
COST_SOURCE_FORECAST = "q2_unit_cost_forecast"

# Weekly spine: offsets 0..103.
MAX_WEEK_OFFSET = 103

# Status bands.
INVENTORY_BANDS = ("0-1 weeks of supply", "1-3 weeks of supply", ">3 weeks of supply")
SUPPLY_PLAN_BANDS = (
    ">= 100% of total demand next 8 weeks",
    ">= 90% and < 100% of total demand next 8 weeks",
    ">= 50% and < 90% of total demand next 8 weeks",
    "< 50% of total demand next 8 weeks",
)
SHIPMENT_BANDS = (
    ">= 100% of total demand past 8 weeks",
    ">= 90% and < 100% of total demand past 8 weeks",
    ">= 50% and < 90% of total demand past 8 weeks",
    "< 50% of total demand past 8 weeks",
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class LocationRule:
    """One ordered rule: a case-sensitive SQL LIKE pattern and its category."""

    pattern: str
    category: str


@dataclass(frozen=True)
class ShipmentFields:
    """Candidate column names of the loosely typed shipment sources.

    The first candidate present in the frame and parsable wins. ``configured``
    entries (if set) are tried before the defaults.
    """

    id_candidates: tuple[str, ...] = ("shipment_id", "id")
    status_candidates: tuple[str, ...] = ("state", "status", "shipment_status")
    updated_candidates: tuple[str, ...] = (
        "updated_at",
        "updated_date",
        "write_date",
        "modified_at",
        "_fivetran_synced",
        "synced_at",
        "created_at",
        "create_date",
    )
    line_shipment_id: str = "shipment_id"
    part_candidates: tuple[str, ...] = (
        "default_code",
        "product_default_code",
        "part_number",
        "odoo_part_code",
        "part_code",
    )
    quantity_candidates: tuple[str, ...] = (
        "quantity_in_shipment",
        "quantity",
        "product_qty",
        "product_uom_qty",
    )
    #: The column that holds each row's fields as one object (VARIANT or JSON text), where a source has one.
    row_object: str | None = None
    configured_status: str | None = None
    configured_part: str | None = None
    configured_quantity: str | None = None


@dataclass(frozen=True)
class SourceColumns:
    """Configured column names of inventory and supply-plan sources."""

    inventory_part: str = "default_code"
    inventory_quantity: str = "quantity"
    inventory_location: str = "stock_location_id"
    plan_part: str = "part_number"
    plan_quantity: str = "quantity"
    plan_date: str = "date"
    alternates_text: str = "part_numbers"
    forecast_cost: str = "unit_cost_q2"
    forecast_synced: str = "synced_at"


@dataclass(frozen=True)
class ReportParams:
    as_of: dt.date
    since: dt.date = dt.date(2025, 1, 1)
    max_week_offset: int = MAX_WEEK_OFFSET
    buy_intent: str = "company_buy"
    revision_pattern: str = REVISION_SEGMENT_PATTERN
    terminal_statuses: tuple[str, ...] = TERMINAL_SHIPMENT_STATUSES
    location_rules: tuple[LocationRule, ...] = ()
    unknown_category: str = UNKNOWN
    columns: SourceColumns = field(default_factory=SourceColumns)
    shipments: ShipmentFields = field(default_factory=ShipmentFields)
    po_cost_label: str = COST_SOURCE_PO
    forecast_cost_label: str = COST_SOURCE_FORECAST

    @property
    def week0(self) -> dt.date:
        """Monday of the as-of week."""
        return self.as_of - dt.timedelta(days=self.as_of.weekday())

    def week(self, n: int) -> dt.date:
        """Monday ``n`` weeks from the as-of week (negative goes back)."""
        return self.week0 + dt.timedelta(weeks=n)
