"""Hand-made report inputs for tests."""

from __future__ import annotations

import datetime as dt

from kitwise.params import LocationRule, ReportParams
from kitwise.sources.tables import INPUT_NAMES, TableInputs

AS_OF = dt.date(2026, 3, 11)  # a Wednesday; W0 = 2026-03-09
FUTURE = "03/16/2026"

PARAMS = ReportParams(
    as_of=AS_OF,
    since=dt.date(2025, 1, 1),
    buy_intent="buy",
    location_rules=(LocationRule("WH%", "Warehouse"), LocationRule("RCV%", "Receiving & Pre-IQC")),
)

BOM_FIELDS = (
    "path part_number revision product_name production_state indent_level uom tracking is_consumable_storable "
    "parent_bom parent_revision top_level_bom top_level_revision quantity procurement_intent adjusted_quantity "
    "adjusted_procurement_intent global_alternate_part_numbers substitute_part_numbers"
).split()


def bom_row(path, part, root, qty, intent="buy", indent=1, parent=None, root_rev="R1", consumable="false"):
    d = dict.fromkeys(BOM_FIELDS)
    d.update(
        path=path,
        part_number=part,
        revision="A",
        indent_level=indent,
        is_consumable_storable=consumable,
        parent_bom=parent if parent is not None else (root if indent > 0 else None),
        top_level_bom=root,
        top_level_revision=root_rev,
        quantity=float(qty),
        adjusted_quantity=float(qty),
        procurement_intent=intent,
        adjusted_procurement_intent=intent,
    )
    return tuple(d[f] for f in BOM_FIELDS)


def make_inputs(spark, empty, **rows) -> TableInputs:
    """Inputs where the named tables get ``rows`` and all others stay empty."""
    frames = {}
    for n in INPUT_NAMES:
        if n in rows:
            frames[n] = spark.createDataFrame(rows[n], schema=empty[n].schema)
        else:
            frames[n] = empty[n]
    return TableInputs(**frames)


def demand_rows(roots, date=FUTURE, qty=1.0):
    return [(r, rev, qty, date, "Production") for r, rev in roots]


def inventory_rows(on_hand: dict[str, float], location=1):
    return [(part, float(q), location) for part, q in on_hand.items()]


def locations():
    return [(1, "WH/Stock"), (2, "RCV/Dock")]
