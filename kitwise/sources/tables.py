"""The report's inputs as one object of DataFrames.

A production job fills it from tables or Parquet paths (``from_tables``); the
tests fill it from stand-ins (``kitwise.sources.standins``). Stages take the
frames they need as arguments, never this object, so each stays testable on
hand-made rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

INPUT_NAMES = (
    "bom",
    "demand",
    "structured",
    "flat_parts",
    "alternates",
    "forecast",
    "supply_plans",
    "stock_location",
    "stock_move",
    "product_product",
    "product_template",
    "inventory",
    "shipments",
    "shipment_lines",
    "po_line",
    "po_version",
    "purchase_order",
    "po_supplier",
    "uom",
    "uom_factor",
)


class ReportInputs:
    """Attribute access to the 20 input frames named in ``INPUT_NAMES``."""


@dataclass
class TableInputs(ReportInputs):
    bom: DataFrame
    demand: DataFrame
    structured: DataFrame
    flat_parts: DataFrame
    alternates: DataFrame
    forecast: DataFrame
    supply_plans: DataFrame
    stock_location: DataFrame
    stock_move: DataFrame
    product_product: DataFrame
    product_template: DataFrame
    inventory: DataFrame
    shipments: DataFrame
    shipment_lines: DataFrame
    po_line: DataFrame
    po_version: DataFrame
    purchase_order: DataFrame
    po_supplier: DataFrame
    uom: DataFrame
    uom_factor: DataFrame


def from_tables(spark: SparkSession, locations: dict[str, str], fmt: str = "table") -> TableInputs:
    """Bind every input to a catalog table (``fmt='table'``) or a path.

    ``locations`` maps each name of ``INPUT_NAMES`` to a table name or path.
    """
    missing = [n for n in INPUT_NAMES if n not in locations]
    if missing:
        raise ValueError(f"no location for inputs: {missing}")

    def read(loc: str) -> DataFrame:
        if fmt == "table":
            return spark.table(loc)
        return spark.read.format(fmt).load(loc)

    return TableInputs(**{n: read(locations[n]) for n in INPUT_NAMES})
