"""The stand-in inputs as DuckDB SQL over the driver's test tables.

Same derivations as ``kitwise/sources/standins.py``, written separately in
DuckDB's dialect. Each entry is the body of one CTE; names start with ``in_``.
"""

from __future__ import annotations

from kitwise.sources.standins import LITERAL_ALTERNATE_GROUPS, LOCATION_PREFIXES


def _pnum(k: str) -> str:
    return f"('P' || lpad(CAST({k} AS VARCHAR), 7, '0'))"


_REV = "CASE WHEN p_brand = 'Brand#5' THEN NULL ELSE 'A' END"

_BOM_COLS = (
    ("path", "VARCHAR"),
    ("part_number", "VARCHAR"),
    ("revision", "VARCHAR"),
    ("product_name", "VARCHAR"),
    ("production_state", "VARCHAR"),
    ("indent_level", "INTEGER"),
    ("uom", "VARCHAR"),
    ("tracking", "VARCHAR"),
    ("is_consumable_storable", "VARCHAR"),
    ("parent_bom", "VARCHAR"),
    ("parent_revision", "VARCHAR"),
    ("top_level_bom", "VARCHAR"),
    ("top_level_revision", "VARCHAR"),
    ("quantity", "DOUBLE"),
    ("procurement_intent", "VARCHAR"),
    ("adjusted_quantity", "DOUBLE"),
    ("adjusted_procurement_intent", "VARCHAR"),
    ("global_alternate_part_numbers", "VARCHAR"),
    ("substitute_part_numbers", "VARCHAR"),
)


def _bom_select(src: str, **exprs: str) -> str:
    defaults = {
        "production_state": "'active'",
        "uom": "'EA'",
        "tracking": "'none'",
        "is_consumable_storable": "'false'",
        "global_alternate_part_numbers": "NULL",
        "substitute_part_numbers": "NULL",
    }
    defaults.update(exprs)
    cols = ", ".join(f"CAST({defaults[n]} AS {t}) AS {n}" for n, t in _BOM_COLS)
    return f"SELECT {cols} FROM {src}"


def _bom() -> str:
    sub = "(p_brand || '-' || p_type)"
    sub_path = f"('|' || p_brand || '|A|' || {sub} || '|B01|')"
    intent = "CASE WHEN p_size % 10 = 0 THEN 'supplier_buy' ELSE 'company_buy' END"
    tier0 = _bom_select(
        "(SELECT DISTINCT p_brand FROM part)",
        path="'|' || p_brand || '|A|'",
        part_number="p_brand",
        revision=_REV,
        product_name="p_brand",
        indent_level="0",
        parent_bom="NULL",
        parent_revision="NULL",
        top_level_bom="p_brand",
        top_level_revision=_REV,
        quantity="1",
        procurement_intent="'make'",
        adjusted_quantity="1",
        adjusted_procurement_intent="'make'",
    )
    tier1 = _bom_select(
        "(SELECT p_brand, p_type, min(p_size) AS m FROM part GROUP BY p_brand, p_type)",
        path=sub_path,
        part_number=sub,
        revision="'B01'",
        product_name="p_type",
        indent_level="1",
        parent_bom="p_brand",
        parent_revision=_REV,
        top_level_bom="p_brand",
        top_level_revision=_REV,
        quantity="m % 3",
        procurement_intent="'make'",
        adjusted_quantity="m % 3",
        adjusted_procurement_intent="'make'",
    )
    tier2 = _bom_select(
        "part",
        path=f"{sub_path} || {_pnum('p_partkey')} || '|C|'",
        part_number=_pnum("p_partkey"),
        revision="'C'",
        product_name="p_name",
        indent_level="2",
        tracking="CASE WHEN p_size % 5 = 0 THEN 'serial' ELSE 'none' END",
        is_consumable_storable="CASE WHEN p_size % 9 = 0 THEN 'yes' ELSE 'false' END",
        parent_bom=sub,
        parent_revision="'B01'",
        top_level_bom="p_brand",
        top_level_revision=_REV,
        quantity="p_size",
        procurement_intent=intent,
        adjusted_quantity="p_size",
        adjusted_procurement_intent=intent,
        global_alternate_part_numbers=f"CASE WHEN p_partkey % 20 = 0 THEN {_pnum('p_partkey + 1')} END",
    )
    shared = _bom_select(
        "(SELECT * FROM part WHERE p_partkey % 7 = 0 AND p_brand <> 'Brand#1')",
        path=f"'|Brand#1|A|' || {_pnum('p_partkey')} || '|C|'",
        part_number=_pnum("p_partkey"),
        revision="'C'",
        product_name="p_name",
        indent_level="1",
        parent_bom="'Brand#1'",
        parent_revision="'A'",
        top_level_bom="'Brand#1'",
        top_level_revision="'A'",
        quantity="p_size % 4",
        procurement_intent="'company_buy'",
        adjusted_quantity="p_size % 4",
        adjusted_procurement_intent="'company_buy'",
    )
    nested = _bom_select(
        "(SELECT * FROM part WHERE p_partkey = 0)",
        path="'|Brand#3|A|Brand#2|A|'",
        part_number="'Brand#2'",
        revision="'A'",
        product_name="'Brand#2'",
        indent_level="1",
        parent_bom="'Brand#3'",
        parent_revision="'A'",
        top_level_bom="'Brand#3'",
        top_level_revision="'A'",
        quantity="2",
        procurement_intent="'make'",
        adjusted_quantity="2",
        adjusted_procurement_intent="'make'",
    )
    return "\nUNION ALL\n".join([tier0, tier1, tier2, shared, nested])


def _alternates() -> str:
    literal = " UNION ALL ".join(f"SELECT CAST({i} AS BIGINT), '{t}'" for i, t in LITERAL_ALTERNATE_GROUPS)
    return f"""
SELECT p_partkey AS row_id, {_pnum('p_partkey')} || ', ' || {_pnum('p_partkey + 1')} || ',' || {_pnum('p_partkey + 2')} AS part_numbers
FROM part WHERE p_partkey % 15 = 0
UNION ALL
SELECT p_partkey + 1000000, {_pnum('p_partkey + 2')} || ', ' || {_pnum('p_partkey + 15')}
FROM part WHERE p_partkey % 15 = 0
UNION ALL
SELECT 3000000 + m, p_brand || '-' || p_type || ', Brand#' || CAST(m % 25 + 1 AS VARCHAR)
FROM (SELECT p_brand, p_type, min(p_partkey) AS m FROM part GROUP BY p_brand, p_type)
UNION ALL
{literal}"""


def _locations() -> str:
    prefixes = ", ".join(f"'{p}'" for p in LOCATION_PREFIXES)
    return f"SELECT s_suppkey AS id, [{prefixes}][s_suppkey % 11 + 1] || s_name AS complete_name FROM supplier"


STANDINS: dict[str, str] = {
    "in_bom": _bom(),
    "in_demand": """
SELECT p.p_brand AS part_number,
       CASE WHEN p.p_brand = 'Brand#5' THEN '' ELSE 'A' END AS revision,
       CASE WHEN p.p_brand = 'Brand#7' THEN 0.0 ELSE l.l_quantity END AS quantity,
       CASE WHEN o.o_orderkey % 97 = 0 THEN 'TBD' ELSE strftime(o.o_orderdate, '%m/%d/%Y') END AS date,
       CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Spares'
            WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            ELSE 'Production' END AS demand_type
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "in_structured": """
SELECT regexp_replace(path, '[|][A-Za-z][A-Za-z0-9]{0,2}[|]', '|', 'g') AS path_without_rev,
       top_level_bom AS product,
       CASE WHEN indent_level = 0 THEN NULL ELSE 'V' || CAST(indent_level AS VARCHAR) END AS variant,
       CASE WHEN indent_level >= 1 THEN 'S' || substr(part_number, 6, 1) END AS system,
       parent_bom AS subsystem
FROM in_bom WHERE part_number <> 'Brand#2'""",
    "in_flat_parts": f"""
SELECT {_pnum('p_partkey')} AS part_number, p_type AS new_commodity FROM part WHERE p_partkey % 13 <> 0""",
    "in_alternates": _alternates(),
    "in_forecast": f"""
SELECT CASE WHEN p_partkey % 4 = 0 THEN ' ' || {_pnum('p_partkey')} || ' ' ELSE {_pnum('p_partkey')} END AS part_number,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS unit_cost_q2,
       CAST(DATE '1998-01-01' + p_size AS TIMESTAMP) AS synced_at
FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT {_pnum('p_partkey')}, p_retailprice + 1, CAST(NULL AS TIMESTAMP) FROM part WHERE p_partkey % 6 = 0""",
    "in_supply_plans": f"""
SELECT {_pnum('l_partkey')} AS part_number, l_quantity AS quantity,
       CASE WHEN l_orderkey % 50 = 0 THEN '13/45'
            WHEN l_linenumber = 2 THEN ' ' || strftime(l_shipdate, '%m/%d')
            ELSE strftime(l_shipdate, '%m/%d') END AS date
FROM lineitem WHERE year(l_shipdate) = 1998""",
    "in_stock_location": _locations(),
    "in_stock_move": """
SELECT l_shipdate AS date, l_partkey AS product_id, l_suppkey AS location_id,
       l_suppkey + l_linenumber AS location_dest_id, l_quantity AS product_qty,
       CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'draft' END AS state
FROM lineitem""",
    "in_product_product": "SELECT p_partkey AS id, p_partkey AS product_tmpl_id FROM part",
    "in_product_template": f"SELECT p_partkey AS id, {_pnum('p_partkey')} AS default_code, p_name AS name FROM part",
    "in_inventory": f"""
SELECT {_pnum('l_partkey')} AS default_code, l_quantity AS quantity, l_suppkey AS stock_location_id
FROM lineitem WHERE l_linestatus = 'O'""",
    "in_shipments": """
SELECT CAST(event_id // 5 AS VARCHAR) AS shipment_id,
       CASE event_type WHEN 'purchase' THEN ' In Transit ' WHEN 'signup' THEN 'Delivered / Completed'
                       WHEN 'click' THEN 'draft' WHEN 'error' THEN 'Cancelled' END AS state,
       CAST(ts AS VARCHAR) AS updated_at
FROM events""",
    "in_shipment_lines": f"""
SELECT CAST(event_id // 5 AS VARCHAR) AS shipment_id, {_pnum('user_id')} AS default_code,
       CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS quantity
FROM events WHERE event_type <> 'view'""",
    "in_po_line": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS id, l.l_linenumber AS line_number,
       l.l_orderkey AS purchase_order_version_id, l.l_partkey AS part_template_id, l.l_partkey AS unit_of_measure_id,
       CAST(round(l.l_extendedprice / l.l_quantity * 100) AS BIGINT) * 1000000 AS unit_price_ucents,
       o.o_orderdate AS created_at, 'C' AS major_revision_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "in_po_version": """
SELECT o_orderkey AS id, o_orderkey AS purchase_order_id, o_custkey % 50 AS supplier_id,
       CASE WHEN o_orderstatus = 'F' THEN 'ISSUED' ELSE 'DRAFT' END AS status
FROM orders""",
    "in_purchase_order": "SELECT o_orderkey AS id, 'PO' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS purchase_order_number FROM orders",
    "in_po_supplier": "SELECT s_suppkey AS id, s_name AS name FROM supplier",
    "in_uom": "SELECT p_partkey AS id, p_partkey AS unit_ref_id FROM part WHERE p_size % 4 <> 0",
    "in_uom_factor": "SELECT p_partkey AS id, CAST(p_size % 4 AS DOUBLE) AS factor FROM part",
}
