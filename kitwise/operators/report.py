"""Report assembly (stages L1-L12).

``assemble`` left-joins the spine to every metric table. Tables keyed by part
are first joined into one row per report part (they are already grouped by
part, so the chain shares one partitioning), and path-keyed tables follow
each other for the same reason; the spine is shuffled once per key family.
``publish`` gives the 76 published columns with their names and zero-fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitwise.functions.text import text_key
from kitwise.params import INVENTORY_BANDS, SHIPMENT_BANDS, SUPPLY_PLAN_BANDS
from kitwise.operators.hierarchy import LINE_COLUMNS


def _z(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _unusable(c: Column) -> Column:
    return c.isNull() | (c == 0)


def _bands(value: Column, target: Column, labels: tuple[str, ...]) -> Column:
    return (
        F.when(target == 0, F.lit(labels[0]))
        .when(value >= target, F.lit(labels[0]))
        .when(value >= target * 0.9, F.lit(labels[1]))
        .when(value >= target * 0.5, F.lit(labels[2]))
        .otherwise(F.lit(labels[3]))
    )


def status_columns(wos: Column, plan_alt_8w: Column, net_next8: Column, received_alt_8w: Column, net_past8: Column):
    """Inventory, supply plan and shipment status bands."""
    w = F.coalesce(wos, F.lit(0.0))
    inventory = (
        F.when(w <= 1, F.lit(INVENTORY_BANDS[0])).when(w <= 3, F.lit(INVENTORY_BANDS[1])).otherwise(F.lit(INVENTORY_BANDS[2]))
    )
    plan = _bands(F.coalesce(plan_alt_8w, F.lit(0.0)), F.coalesce(net_next8, F.lit(0.0)), SUPPLY_PLAN_BANDS)
    ship = _bands(F.coalesce(received_alt_8w, F.lit(0.0)) * 8, F.coalesce(net_past8, F.lit(0.0)), SHIPMENT_BANDS)
    return inventory, plan, ship


def part_metrics(
    parts: DataFrame,
    rollup: DataFrame,
    alt_text: DataFrame,
    cost: DataFrame,
    rates: DataFrame,
    rates_alt: DataFrame,
    inv: DataFrame,
    transit_alt: DataFrame,
    inv_alt: DataFrame,
    plan: DataFrame,
    plan_alt: DataFrame,
) -> DataFrame:
    """One row per report part with every part-keyed metric."""
    out = parts.select("part_number")
    for t in (rollup, alt_text, cost, rates, rates_alt, inv, transit_alt, inv_alt, plan, plan_alt):
        out = out.join(t, "part_number", "left")
    return out


def assemble(
    spine: DataFrame,
    parts: DataFrame,
    line_demand: DataFrame,
    parent_stock: DataFrame,
    parent_alts: DataFrame,
    wos: DataFrame,
    po: DataFrame,
    net: DataFrame,
    system_min: DataFrame,
) -> DataFrame:
    """The raw report, one row per spine row (more where lookups repeat)."""
    # Path-keyed (demand per line is joined by path only, as in the report).
    j = (
        spine.join(line_demand.drop("part_number", "revision"), "path", "left")
        .join(parent_stock, "path", "left")
        .join(parent_alts, "path", "left")
        .join(wos.drop("part_number", "revision"), "path", "left")
    )
    j = j.join(parts, "part_number", "left")
    pr = po.select(
        F.col("part_number").alias("_po_part"),
        F.col("revision").alias("_po_rev"),
        "latest_po",
        "latest_supplier",
        "latest_po_created_at",
    )
    j = j.join(pr, (j["part_number"] == pr["_po_part"]) & (text_key(j["revision"]) == text_key(pr["_po_rev"])), "left")
    nt = net.withColumnRenamed("part_number", "_net_part").withColumnRenamed("revision", "_net_rev")
    j = j.join(nt, (j["part_number"] == nt["_net_part"]) & (text_key(j["revision"]) == text_key(nt["_net_rev"])), "left")
    sm = system_min.select(
        F.col("top_level_bom").alias("_sm_root"),
        F.col("top_level_revision").alias("_sm_key"),
        F.col("system_group").alias("_sm_sys"),
        "system_min_in_transit_weeks",
    )
    j = j.join(
        sm,
        (j["top_level_bom"] == sm["_sm_root"])
        & (text_key(j["top_level_revision"]) == sm["_sm_key"])
        & (text_key(j["system"]) == sm["_sm_sys"]),
        "left",
    )
    roll = F.col("total_rolled_up_quantity")
    no_roll = _unusable(roll)
    no_parents = _unusable(F.col("valid_parent_count"))
    sets_alt = F.when(no_roll, F.lit(None).cast("double")).otherwise(_z("on_hand_alt") / roll)
    sets_alt_or_zero = F.when(no_roll, F.lit(0.0)).otherwise(_z("on_hand_alt") / roll)
    sets_transit_or_zero = F.when(no_roll, F.lit(0.0)).otherwise((_z("on_hand_alt") + _z("in_transit_alt")) / roll)
    inventory_status, plan_status, ship_status = status_columns(
        F.col("weeks_of_stock"),
        F.col("plan_total_8w_alt"),
        F.col("net_next8"),
        F.col("received_avg_8w_alt"),
        F.col("net_past8"),
    )
    return j.select(
        "path",
        "path_without_revision",
        *[c for c in LINE_COLUMNS if c != "path"],
        roll.cast("double").alias("total_rolled_up_quantity"),
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
        _z("on_hand_in_parents").alias("on_hand_in_parents"),
        _z("on_hand_in_alt_parents").alias("on_hand_in_alt_parents"),
        _z("in_transit_in_alt_parents").alias("in_transit_in_alt_parents"),
        _z("in_transit_alt").alias("in_transit_alt"),
        (_z("in_transit_alt") * _z("unit_cost")).cast("double").alias("in_transit_value_alt"),
        (_z("on_hand") - _z("net_current_week")).alias("on_hand_delta"),
        "quarantine",
        "on_hand_alt",
        "receiving_alt",
        _z("weeks_of_stock").alias("weeks_of_stock"),
        _z("weeks_of_stock_with_in_transit").alias("weeks_of_stock_with_in_transit"),
        _z("in_transit_weeks_of_stock").alias("in_transit_weeks_of_stock"),
        _z("system_min_in_transit_weeks").alias("system_min_in_transit_weeks"),
        (_z("on_hand_alt") + _z("on_hand_in_parents")).cast("double").alias("on_hand_with_alt_and_parents"),
        (_z("on_hand_value_alt") + _z("on_hand_in_parents") * _z("unit_cost"))
        .cast("double")
        .alias("on_hand_value_with_alt_and_parents"),
        sets_alt.cast("double").alias("sets_alt"),
        F.when(no_roll, F.lit(None).cast("double")).otherwise(_z("receiving_alt") / roll).alias("sets_receiving"),
        _z("sets_of_alt_parents").alias("sets_of_alt_parents"),
        _z("sets_with_in_transit_of_alt_parents").alias("sets_with_in_transit_of_alt_parents"),
        F.when(no_roll & no_parents, F.lit(None).cast("double"))
        .otherwise(sets_alt_or_zero + _z("sets_in_parents"))
        .alias("sets_alt_and_parents"),
        F.when(no_roll & no_parents, F.lit(None).cast("double"))
        .otherwise(sets_transit_or_zero + _z("sets_in_parents"))
        .alias("sets_with_in_transit"),
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
        inventory_status.alias("inventory_status"),
        plan_status.alias("supply_plan_status"),
        ship_status.alias("shipments_status"),
    )


# Published columns in order: (published name, raw column, NULL becomes 0).
PUBLISHED_COLUMNS = (
    ("PATH", "path", False),
    ("PATH_WITHOUT_REVISION", "path_without_revision", False),
    ("PART_NUMBER", "part_number", False),
    ("REVISION", "revision", False),
    ("PRODUCT_NAME", "product_name", False),
    ("PRODUCTION_STATE", "production_state", False),
    ("INDENT_LEVEL", "indent_level", False),
    ("UOM", "uom", False),
    ("TRACKING", "tracking", False),
    ("IS_CONSUMABLE_STORABLE", "is_consumable_storable", False),
    ("PARENT_BOM", "parent_bom", False),
    ("PARENT_REVISION", "parent_revision", False),
    ("TOP_LEVEL_BOM", "top_level_bom", False),
    ("TOP_LEVEL_REVISION", "top_level_revision", False),
    ("QUANTITY", "quantity", False),
    ("PROCUREMENT_INTENT", "procurement_intent", False),
    ("ADJUSTED_QUANTITY", "adjusted_quantity", False),
    ("total rolled up quantity", "total_rolled_up_quantity", False),
    ("ADJUSTED_PROCUREMENT_INTENT", "adjusted_procurement_intent", False),
    ("GLOBAL_ALTERNATE_PART_NUMBERS", "global_alternate_part_numbers", False),
    ("SUBSTITUTE_PART_NUMBERS", "substitute_part_numbers", False),
    ("Supply Plan and On-Hand Alternates", "alternates_text", False),
    ("Latest PO", "latest_po", False),
    ("Latest Supplier", "latest_supplier", False),
    ("Latest PO Creation Date", "latest_po_created_at", False),
    ("Unit Cost Used", "unit_cost", False),
    ("Unit Cost Source", "unit_cost_source", False),
    ("Product", "product", False),
    ("Variant", "variant", False),
    ("System", "system", False),
    ("Subsystem", "subsystem", False),
    ("Gross Demand for BOM Line in past 8 weeks", "gross_past8", True),
    ("Net Total Demand for Part Number in past 8 weeks", "net_past8", True),
    ("Current Week Total Gross Demand", "gross_current_week", True),
    ("Current Week Net Demand", "net_current_week", True),
    ("Current Week Net Total Demand", "net_current_week", True),
    ("Current Week Realized Demand Consumption (each)", "consumption_current_week", True),
    ("Gross Demand for BOM Line in next 8 weeks", "gross_next8", True),
    ("Net Total Demand for Part Number in next 8 weeks", "net_next8", True),
    ("Quantity Received, 8-Week Rolling Average (each)", "received_avg_8w", True),
    ("Quantity Received, Average Since Last Receipt (each)", "received_rate_since_last", True),
    ("Current On-Hand Quantity (each)", "on_hand", True),
    ("Current Receiving & Pre-IQC Quantity (each)", "receiving", True),
    ("On Hand Quantity In Parents", "on_hand_in_parents", True),
    ("On Hand Quantity In Alternates Of Parents", "on_hand_in_alt_parents", True),
    ("In-Transit Quantity In Alternates Of Parents", "in_transit_in_alt_parents", True),
    ("in-transit quantity including alternates", "in_transit_alt", True),
    ("in-transit inventory value including alternates", "in_transit_value_alt", True),
    ("On Hand Delta to Current Week Demand (each)", "on_hand_delta", True),
    ("Current Quarantine Quantity (each)", "quarantine", True),
    ("Current Week Realized Supply (each)", "current_week_supply", True),
    ("Total Supply Plan, next 8 weeks (each)", "plan_total_8w", True),
    ("Average Supply Plan, next 8 weeks (each)", "plan_avg_8w", True),
    ("Quantity Received, 8-Week Rolling Average (each) with alternates", "received_avg_8w_alt", True),
    ("Quantity Received, Average Since Last Receipt (each) with alternates", "received_rate_since_last_alt", True),
    ("Current On-Hand Quantity (each) with alternates", "on_hand_alt", True),
    ("Current Receiving & Pre-IQC Quantity (each) with alternates", "receiving_alt", True),
    ("Weeks of Stock", "weeks_of_stock", True),
    ("Weeks of Stock with In Transit", "weeks_of_stock_with_in_transit", True),
    ("in transit weeks of stock", "in_transit_weeks_of_stock", True),
    ("In Transit Weeks of Stock Of System's Minimum Weeks of Stock Part", "system_min_in_transit_weeks", True),
    ("Current On Hand Quantity Including alternates and parents", "on_hand_with_alt_and_parents", True),
    ("Current On Hand Inventory Value Including alternates and parents", "on_hand_value_with_alt_and_parents", True),
    ("on hand product sets including alternates", "sets_alt", False),
    ("receiving & pre-iqc product sets", "sets_receiving", False),
    ("on hand product sets of alternates of parents", "sets_of_alt_parents", True),
    ("on hand + in transit product sets of alternates of parents", "sets_with_in_transit_of_alt_parents", True),
    ("on hand product sets including alternates and parents", "sets_alt_and_parents", False),
    ("on hand + in transit product sets", "sets_with_in_transit", False),
    ("Current Quarantine Quantity (each) with alternates", "quarantine_alt", True),
    ("Current Week Realized Supply (each) with alternates", "current_week_supply_alt", True),
    ("Total Supply Plan, next 8 weeks (each) with alternates", "plan_total_8w_alt", True),
    ("Average Supply Plan, next 8 weeks (each) with alternates", "plan_avg_8w_alt", True),
    ("On Hand Inventory Status", "inventory_status", False),
    ("Supply Plan Status", "supply_plan_status", False),
    ("Avg Shipments Status", "shipments_status", False),
)


def publish(raw: DataFrame) -> DataFrame:
    """The 76 published columns, numeric metrics with NULL as 0.

    A raw column that is missing (a raw frame from elsewhere) is published as
    NULL, or 0 where NULL becomes 0.
    """
    have = set(raw.columns)
    cols = []
    for name, src, zero in PUBLISHED_COLUMNS:
        c = F.col(src) if src in have else F.lit(None)
        if zero:
            c = F.coalesce(c.try_cast("double"), F.lit(0.0))  # text that is no number counts as NULL
        elif src not in have:
            c = c.cast("string")
        cols.append(c.alias(name))
    return raw.select(*cols)
