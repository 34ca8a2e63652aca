"""Stages stated from the report's rules, by other means than the engine's.

Rule tables are joined as rows, both sides of a join are summed first, weeks are
lists, ties are settled by ``DISTINCT ON`` orders or by the largest struct. All
fixed values are spelled out here; nothing comes from the engine.
"""

from __future__ import annotations

# Category, movement and status names as the report publishes them.
_LOCATION_RULES = """(VALUES
  (1, 'Vendors%', 'Vendors'), (2, 'Plant%', 'Production'), (3, 'HUB/WH/Stock/Spares Pick%', 'Nest'),
  (4, 'HUB/Quarantine/Rework/Production%', 'Warehouse'), (5, '%Quarantine%', 'Quarantine'), (6, '%Scrap%', 'Scrap'),
  (7, '%Nest%', 'Nest'), (8, 'HUB/Input%', 'Receiving & Pre-IQC'), (9, 'HUB/WH%', 'Warehouse'), (10, 'HUB/R&D%', 'R&D')
) AS t(place, pattern, category)"""

_MOVE_RULES = """(VALUES
  ('Vendors', TRUE, 'New Supply', 1), ('Vendors', FALSE, 'New Supply', -1),
  ('Nest', FALSE, 'Nest Consumption', 1), ('Nest', TRUE, 'RMA Supply', 1),
  ('Production', FALSE, 'Production Consumption', 1), ('Production', TRUE, 'Production Consumption', -1),
  ('Scrap', FALSE, 'QC Loss Consumption', 1), ('Scrap', TRUE, 'QC Loss Consumption', -1),
  ('Quarantine', FALSE, 'QC Loss Consumption', 1), ('Quarantine', TRUE, 'QC Loss Consumption', -1),
  ('R&D', FALSE, 'R&D Consumption', 1), ('R&D', TRUE, 'R&D Supply', 1)
) AS t(place, into_stock, category, sign)"""

_ENDED = "['DRAFT', 'CANCELED', 'CANCELLED', 'DELIVERED', 'DELIVERED_COMPLETED', 'COMPLETE', 'COMPLETED', 'DONE']"
PO_COST_LABEL = "latest_purchase_order"
FORECAST_COST_LABEL = "q2_unit_cost_forecast"

_NEWEST = (
    "po_created_at DESC NULLS FIRST, purchase_order_number DESC NULLS FIRST, line_number DESC NULLS FIRST, "
    "id DESC NULLS FIRST, unit_cost DESC NULLS FIRST"
)


def _covered(stock: str) -> str:
    """The part of each week's demand that stock covers, given the demand of the weeks before."""
    left = f"({stock} - before)"
    return f"IF(before > {stock}, 0.0, IF(need <= 0 OR {left} >= need, 1.0, greatest({left}, 0) / need))"


RULES: dict[str, str] = {
    # paths: a line's ancestors are the lines of its root whose path is one of its proper beginnings
    "beginnings": """
SELECT DISTINCT top_level_bom, COALESCE(top_level_revision, '') AS rev, path_without_revision AS whole,
       substr(path_without_revision, 1, n) AS beginning
FROM (SELECT DISTINCT top_level_bom, top_level_revision, path_without_revision,
             unnest(range(0, length(path_without_revision))) AS n FROM lines WHERE top_level_bom IS NOT NULL)""",
    "assemblies": """
SELECT * FROM lines WHERE part_number IN (SELECT part_number FROM child_parts)""",
    "ancestor_usage": """
SELECT c.path, a.part_number AS parent_part_number, a.top_level_bom, s.rev AS top_level_revision,
       COALESCE(c.adjusted_quantity, 0) / NULLIF(a.adjusted_quantity, 0) AS child_quantity_in_parent
FROM beginnings s
JOIN assemblies a ON a.path_without_revision = s.beginning AND a.top_level_bom = s.top_level_bom
 AND s.rev = COALESCE(a.top_level_revision, '')
JOIN lines c ON c.path_without_revision = s.whole AND c.top_level_bom = s.top_level_bom
 AND s.rev = COALESCE(c.top_level_revision, '')
WHERE c.part_number IS NOT NULL""",
    # roots: what is asked for, less what is inside something else
    "demanded_roots": "SELECT part_number, revision FROM eligible_roots ANTI JOIN child_parts USING (part_number)",
    # demand: spans of weeks are rows, demand is summed a root and span before it meets the lines
    "demand_spans": """
SELECT * FROM (VALUES
  ('gross_past8', DATE '@W0m7@', DATE '@W0@'), ('gross_next4', DATE '@W0@', DATE '@W0p4@' - 7),
  ('gross_next8', DATE '@W0@', DATE '@W0p8@' - 7), ('gross_current', DATE '@W0@', DATE '@W0@')) AS t(span, first_week, last_week)""",
    "root_spans": """
SELECT d.top_level_bom AS root, COALESCE(d.top_level_revision, '') AS rev, d.demand_type, s.span,
       sum(IF(d.demand_week BETWEEN s.first_week AND s.last_week, d.demand_quantity, 0)) AS asked
FROM demand_rows d, demand_spans s GROUP BY ALL""",
    "lines_asked": """
SELECT l.path, l.part_number, l.revision, r.demand_type, s.span,
       IF(r.root IS NULL, 0, r.asked * COALESCE(l.adjusted_quantity, 0)) AS gross
FROM lines l CROSS JOIN demand_spans s
LEFT JOIN root_spans r ON r.root = l.top_level_bom AND r.rev = COALESCE(l.top_level_revision, '') AND r.span = s.span""",
    "line_gross_demand": """
SELECT * FROM (PIVOT lines_asked ON span IN ('gross_past8', 'gross_next4', 'gross_next8') USING sum(gross)
               GROUP BY path, part_number, revision)""",
    "part_gross_demand_by_type": """
SELECT * FROM (PIVOT lines_asked ON span IN ('gross_past8', 'gross_next8', 'gross_current') USING sum(gross)
               GROUP BY part_number, revision, demand_type)""",
    "part_gross_demand_this_week": """
SELECT part_number, revision, sum(gross_current) AS current_week_gross FROM part_gross_demand_by_type GROUP BY ALL""",
    "root_weeks": """
SELECT top_level_bom AS root, COALESCE(top_level_revision, '') AS rev, demand_week, demand_type, sum(demand_quantity) AS asked
FROM demand_rows WHERE demand_week >= DATE '@W0@' GROUP BY ALL""",
    "parts_in_roots": """
SELECT part_number, revision, top_level_bom AS root, COALESCE(top_level_revision, '') AS rev,
       sum(COALESCE(adjusted_quantity, 0)) AS used
FROM lines GROUP BY ALL""",
    "weekly_gross_demand": """
SELECT p.part_number, p.revision, w.demand_week, w.demand_type, sum(w.asked * p.used) AS gross_week_demand
FROM parts_in_roots p JOIN root_weeks w USING (root, rev) GROUP BY ALL""",
    # consumption by the demand type it is taken from
    "used_by_type": """
UNPIVOT (SELECT part_number, COALESCE(production_consumption, 0) AS "Production", COALESCE(nest_consumption, 0) AS "Spares"
         FROM consumption_this_week)
ON "Production", "Spares" INTO NAME demand_type VALUE used""",
    "weekly_entries": """
SELECT part_number, revision, demand_week, COALESCE(gross_week_demand, 0) AS amount FROM weekly_gross_demand
UNION ALL
SELECT w.part_number, w.revision, w.demand_week, -u.used
FROM weekly_gross_demand w JOIN used_by_type u USING (part_number, demand_type) WHERE w.demand_week = DATE '@W0@'""",
    "weekly_remaining_demand": """
SELECT part_number, revision, demand_week, CAST(greatest(sum(amount), 0) AS DOUBLE) AS week_demand
FROM weekly_entries GROUP BY ALL""",
    "this_week_by_key": """
SELECT part_number, COALESCE(revision, '') AS rev, count(*) AS forms, max(COALESCE(current_week_gross, 0)) AS gross
FROM part_gross_demand_this_week GROUP BY ALL""",
    "part_net_demand": """
WITH per AS (
  SELECT g.part_number, g.revision, sum(g.gross_past8) AS p8, sum(g.gross_next8) AS n8, sum(g.gross_current) AS now,
         COALESCE(sum(u.used), 0) AS used
  FROM part_gross_demand_by_type g
  LEFT JOIN used_by_type u ON u.part_number = g.part_number AND u.demand_type = g.demand_type
  GROUP BY ALL)
SELECT per.part_number, per.revision, f * (p8 - used) AS net_past8, f * (n8 - used) AS net_next8,
       f * (now - used) AS net_current_week, COALESCE(t.gross, 0) AS gross_current_week, f * used AS consumption_current_week
FROM (SELECT per.*, COALESCE(t.forms, 1) AS f FROM per
      LEFT JOIN this_week_by_key t ON t.part_number = per.part_number AND t.rev = COALESCE(per.revision, '')) per
LEFT JOIN this_week_by_key t ON t.part_number = per.part_number AND t.rev = COALESCE(per.revision, '')""",
    # purchasing
    "issued": """
SELECT v.id AS version_id, v.supplier_id, o.purchase_order_number
FROM in_po_version v LEFT JOIN in_purchase_order o ON o.id = v.purchase_order_id WHERE v.status = 'ISSUED'""",
    "unit_factor": "SELECT u.id AS unit_id, f.factor FROM in_uom u JOIN in_uom_factor f ON f.id = u.unit_ref_id",
    "po_line_versions": """
WITH priced AS (
  SELECT l.id, i.purchase_order_number, l.line_number, l.created_at AS po_created_at, t.default_code AS part_number,
         s.name AS supplier_name, l.major_revision_name AS revision, l.unit_price_ucents / 1e8 AS unit_price,
         k.factor AS uom_factor
  FROM in_po_line l
  JOIN issued i ON i.version_id = l.purchase_order_version_id
  JOIN in_product_template t ON t.id = l.part_template_id AND t.default_code IS NOT NULL
  LEFT JOIN in_po_supplier s ON s.id = i.supplier_id
  LEFT JOIN unit_factor k ON k.unit_id = l.unit_of_measure_id)
SELECT *, unit_price * COALESCE(uom_factor, 1) AS unit_cost FROM priced""",
    "po_line_latest": """
SELECT DISTINCT ON (purchase_order_number, line_number, part_number) * FROM po_line_versions
ORDER BY purchase_order_number, line_number, part_number,
         po_created_at DESC NULLS FIRST, id DESC NULLS FIRST, unit_cost DESC NULLS FIRST""",
    "latest_po": f"""
SELECT DISTINCT ON (part_number, COALESCE(revision, '')) part_number, revision, purchase_order_number AS latest_po,
       supplier_name AS latest_supplier, po_created_at AS latest_po_created_at, unit_cost
FROM po_line_latest ORDER BY part_number, COALESCE(revision, ''), {_NEWEST}""",
    "latest_part_cost": f"""
SELECT DISTINCT ON (part_number) part_number, unit_cost FROM po_line_latest ORDER BY part_number, {_NEWEST}""",
    "forecast_cost": """
SELECT DISTINCT ON (part) part AS part_number, CAST(unit_cost_q2 AS DOUBLE) AS unit_cost
FROM (SELECT trim(part_number) AS part, unit_cost_q2, synced_at FROM in_forecast)
WHERE part <> '' AND unit_cost_q2 IS NOT NULL
ORDER BY part, synced_at DESC NULLS LAST, unit_cost_q2 DESC""",
    "part_cost": f"""
SELECT part_number, arg_min(cost, turn) FILTER (cost IS NOT NULL) AS unit_cost,
       arg_min(label, turn) FILTER (cost IS NOT NULL) AS unit_cost_source
FROM (SELECT part_number, NULLIF(unit_cost, 0) AS cost, 1 AS turn, '{PO_COST_LABEL}' AS label FROM latest_part_cost
      UNION ALL SELECT part_number, unit_cost, 2, '{FORECAST_COST_LABEL}' FROM forecast_cost)
GROUP BY part_number""",
    # movements
    "location_category": f"""
SELECT l.id, l.complete_name, COALESCE(arg_min(r.category, r.place), 'Unknown') AS category
FROM in_stock_location l LEFT JOIN {_LOCATION_RULES.replace('AS t(', 'AS r(')} ON l.complete_name LIKE r.pattern
GROUP BY l.id, l.complete_name""",
    "moves": f"""
WITH placed AS (
  SELECT m.date, t.default_code AS part_number, t.name, m.product_qty, o.category AS origin_category,
         d.category AS destination_category,
         o.category IN ('Warehouse', 'Receiving & Pre-IQC') AS from_stock,
         d.category IN ('Warehouse', 'Receiving & Pre-IQC') AS to_stock
  FROM in_stock_move m
  LEFT JOIN in_product_product p ON p.id = m.product_id
  LEFT JOIN in_product_template t ON t.id = p.product_tmpl_id
  LEFT JOIN location_category o ON o.id = m.location_id
  LEFT JOIN location_category d ON d.id = m.location_dest_id
  WHERE m.state = 'done' AND m.date >= TIMESTAMP '@SINCE@')
SELECT p.date, p.part_number, p.name, p.product_qty, p.origin_category, p.destination_category,
       COALESCE(t.category, 'Unknown') AS movement_category, t.sign * p.product_qty AS movement_quantity
FROM placed p LEFT JOIN {_MOVE_RULES}
  ON from_stock <> to_stock AND t.into_stock = to_stock AND t.place = IF(to_stock, origin_category, destination_category)""",
    # receipts: one row a part, then summed over alternates
    "received": """
SELECT part_number, sum(IF(receipt_week BETWEEN DATE '@W0m3@' AND DATE '@W0@', quantity, 0)) AS w4,
       sum(IF(receipt_week BETWEEN DATE '@W0m7@' AND DATE '@W0@', quantity, 0)) AS w8,
       max({'d': date, 'q': quantity}) AS last
FROM receipts GROUP BY part_number""",
    "receipt_rates": """
SELECT part_number, w4 / 4.0 AS received_avg_4w, w8 / 8.0 AS received_avg_8w,
       last.q / NULLIF((DATE '@ASOF@' - CAST(last.d AS DATE)) / 7.0, 0) AS received_rate_since_last
FROM received""",
    "received_alt": """
SELECT b.base_part_number AS part_number, COALESCE(sum(r.w4), 0) AS w4, COALESCE(sum(r.w8), 0) AS w8, max(r.last) AS last
FROM alternate_bridge b LEFT JOIN received r ON r.part_number = b.related_part_number GROUP BY ALL""",
    "latest_receipt_alt": """
SELECT part_number, last.d AS date, last.q AS quantity FROM received_alt WHERE last IS NOT NULL""",
    "receipt_rates_alt": """
SELECT part_number, w4 / 4.0 AS received_avg_4w_alt, w8 / 8.0 AS received_avg_8w_alt,
       last.q / NULLIF((DATE '@ASOF@' - CAST(last.d AS DATE)) / 7.0, 0) AS received_rate_since_last_alt
FROM received_alt""",
    # transit
    "in_transit": f"""
SELECT part_number, CAST(sum(quantity) AS DOUBLE) AS in_transit_quantity
FROM shipment_lines WHERE part_number IS NOT NULL AND NOT list_contains({_ENDED}, shipment_status) GROUP BY ALL""",
    "in_transit_alt": """
WITH amounts AS (
  SELECT part_number, in_transit_quantity AS q FROM in_transit
  UNION ALL
  SELECT d.base_part_number, t.in_transit_quantity FROM directed_bridge d JOIN in_transit t ON t.part_number = d.related_part_number
  WHERE d.base_part_number <> d.related_part_number AND t.in_transit_quantity > 0
), total AS (SELECT part_number, sum(q) AS q FROM amounts GROUP BY ALL)
SELECT r.part_number, CAST(COALESCE(total.q, 0) AS DOUBLE) AS in_transit_alt FROM report_parts r LEFT JOIN total USING (part_number)""",
    # parents and buildable sets
    "position": """
SELECT part_number, sum(on_hand) AS on_hand, sum(transit) AS transit, sum(net) AS net
FROM (SELECT part_number, COALESCE(on_hand, 0) AS on_hand, 0 AS transit, 0 AS net FROM inventory_by_part
      UNION ALL SELECT part_number, 0, COALESCE(in_transit_quantity, 0), 0 FROM in_transit
      UNION ALL SELECT part_number, 0, 0, COALESCE(current_week_net_demand, 0) FROM part_net_demand_this_week)
WHERE part_number IS NOT NULL GROUP BY part_number""",
    "alt_parent_latest_rev": """
SELECT top_level_bom AS alternate_parent_part_number, max(COALESCE(top_level_revision, '')) AS top_level_revision
FROM in_bom
WHERE part_number IS NOT NULL
  AND top_level_bom IN (SELECT alternate_parent_part_number FROM parent_alternate_candidates)
GROUP BY ALL""",
    "bought_children": """
SELECT top_level_bom, COALESCE(top_level_revision, '') AS rev, part_number, adjusted_quantity
FROM in_bom
WHERE part_number IS NOT NULL AND adjusted_quantity > 0 AND adjusted_procurement_intent = '@BUY@'
  AND lower(trim(COALESCE(CAST(is_consumable_storable AS VARCHAR), ''))) NOT IN ('t', 'true', 'y', 'yes', '1', 'on')
  AND (trim(COALESCE(parent_bom, '')) <> '' OR indent_level > 0)""",
    "alt_parent_requirements": """
SELECT top_level_bom AS alternate_parent_part_number, part_number AS component_part_number,
       sum(adjusted_quantity) AS component_required_quantity
FROM bought_children
WHERE (top_level_bom, rev) IN (SELECT (alternate_parent_part_number, top_level_revision) FROM alt_parent_latest_rev)
GROUP BY ALL""",
    "component_bridge": """
SELECT component_part_number AS base_part_number, component_part_number AS related_part_number FROM alt_parent_requirements
UNION
SELECT mine.part_number, other.part_number FROM groups mine JOIN groups other USING (group_id)
WHERE mine.part_number IN (SELECT component_part_number FROM alt_parent_requirements)""",
    "alt_component_supply": """
SELECT base_part_number AS component_part_number, greatest(h - n, 0) AS available_on_hand,
       greatest(h + t - n, 0) AS available_with_in_transit
FROM (SELECT b.base_part_number, COALESCE(sum(on_hand), 0) AS h, COALESCE(sum(transit), 0) AS t, COALESCE(sum(net), 0) AS n
      FROM component_bridge b LEFT JOIN position p ON p.part_number = b.related_part_number GROUP BY ALL)""",
    "buildable_sets": """
SELECT alternate_parent_part_number, COALESCE(list_min(list(h)), 0) AS sets_on_hand, COALESCE(list_min(list(t)), 0) AS sets_with_in_transit
FROM (SELECT r.alternate_parent_part_number, s.available_on_hand / r.component_required_quantity AS h,
             s.available_with_in_transit / r.component_required_quantity AS t
      FROM alt_component_supply s RIGHT JOIN alt_parent_requirements r USING (component_part_number))
GROUP BY ALL""",
    "line_parent_alternates": """
WITH worth AS (
  SELECT a.part, COALESCE(p.on_hand, 0) AS h, COALESCE(p.transit, 0) AS t, COALESCE(b.sets_on_hand, 0) AS sh,
         COALESCE(b.sets_with_in_transit, 0) AS st
  FROM (SELECT DISTINCT alternate_parent_part_number AS part FROM parent_alternate_candidates) a
  LEFT JOIN position p ON p.part_number = a.part
  LEFT JOIN buildable_sets b ON b.alternate_parent_part_number = a.part)
SELECT c.path, CAST(sum(h * COALESCE(c.child_quantity_in_parent, 0)) AS DOUBLE) AS on_hand_in_alt_parents,
       CAST(sum(t * COALESCE(c.child_quantity_in_parent, 0)) AS DOUBLE) AS in_transit_in_alt_parents,
       CAST(sum(sh) AS DOUBLE) AS sets_of_alt_parents, CAST(sum(st) AS DOUBLE) AS sets_with_in_transit_of_alt_parents
FROM worth JOIN parent_alternate_candidates c ON c.alternate_parent_part_number = worth.part GROUP BY c.path""",
    "line_parent_stock": """
WITH rolled AS (
  SELECT parent_part_number, top_level_bom, top_level_revision, parent_rolled_up_quantity AS q
  FROM assembly_root_rollup WHERE parent_rolled_up_quantity <> 0
), held AS (
  SELECT u.path, COALESCE(p.on_hand, 0) AS h, COALESCE(u.child_quantity_in_parent, 0) AS per, rolled.q
  FROM ancestor_usage u LEFT JOIN rolled USING (parent_part_number, top_level_bom, top_level_revision)
  LEFT JOIN position p ON p.part_number = u.parent_part_number)
SELECT path, CAST(sum(h * per) AS DOUBLE) AS on_hand_in_parents, CAST(COALESCE(sum(h / q), 0) AS DOUBLE) AS sets_in_parents,
       count(q) AS valid_parent_count
FROM held GROUP BY path""",
    # weeks: one list a part, one list a line, one queue a path
    "last_week": """
SELECT part_number, COALESCE(revision, '') AS rev, max((demand_week - DATE '@W0@') // 7) AS week
FROM weekly_remaining_demand GROUP BY ALL""",
    "demand_horizon": """
SELECT DISTINCT s.path, s.part_number, s.revision, least(@MAXW@, greatest(0, COALESCE(l.week, 0))) AS max_week_offset
FROM spine s LEFT JOIN last_week l ON l.part_number = s.part_number AND l.rev = COALESCE(s.revision, '')
WHERE s.part_number IS NOT NULL AND s.path IS NOT NULL""",
    "week_list": """
SELECT part_number, COALESCE(revision, '') AS rev,
       map_from_entries(list({'k': week, 'v': demands})) AS need
FROM (SELECT part_number, COALESCE(revision, '') AS revision, (demand_week - DATE '@W0@') // 7 AS week,
             list(week_demand ORDER BY revision IS NOT NULL) AS demands
      FROM weekly_remaining_demand GROUP BY 1, 2, 3) GROUP BY ALL""",
    "weekly_stock_position": """
WITH lists AS (
  SELECT h.path, h.part_number, h.revision, COALESCE(i.on_hand_alt, 0) + COALESCE(p.on_hand_in_parents, 0) AS stock,
         COALESCE(t.in_transit_alt, 0) AS in_transit,
         flatten(list_transform(range(0, h.max_week_offset + 1), lambda w:
           list_transform(COALESCE(n.need[w], [0.0]), lambda d: {'w': w, 'd': d}))) AS need
  FROM demand_horizon h
  LEFT JOIN week_list n ON n.part_number = h.part_number AND n.rev = COALESCE(h.revision, '')
  LEFT JOIN inventory_alt i ON i.part_number = h.part_number
  LEFT JOIN line_parent_stock p ON p.path = h.path
  LEFT JOIN in_transit_alt t ON t.part_number = h.part_number
), numbered AS (SELECT * EXCLUDE (need), unnest(need) AS e, unnest(range(0, len(need))) AS nth FROM lists
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY path ORDER BY e.w, md5(concat(part_number, '|', COALESCE(revision, ''))),
                               part_number, revision NULLS FIRST, nth) AS place FROM numbered
), queues AS (SELECT path, list(e.d ORDER BY place) AS queue FROM placed GROUP BY path)
SELECT path, part_number, revision, CAST(e.w AS INTEGER) AS week_offset, CAST(DATE '@W0@' + CAST(7 * e.w AS INTEGER) AS DATE) AS demand_week,
       e.d AS week_demand, stock, stock + in_transit AS stock_with_in_transit, in_transit,
       COALESCE(list_sum(queue[1:place - 1]), 0) AS prior_demand
FROM placed JOIN queues USING (path)""",
    "weekly_coverage": f"""
SELECT * EXCLUDE (need, before), {_covered('stock')} AS week_coverage,
       {_covered('stock_with_in_transit')} AS week_coverage_with_in_transit,
       IF(in_transit <= 0, 0.0, {_covered('in_transit')}) AS week_coverage_in_transit
FROM (SELECT *, week_demand AS need, prior_demand AS before FROM weekly_stock_position)""",
    "system_min_weeks": """
WITH bought AS (
  SELECT s.top_level_bom, COALESCE(s.top_level_revision, '') AS rev, COALESCE(s.system, '') AS grp, s.part_number, s.path,
         COALESCE(w.weeks_of_stock, 0) AS own, COALESCE(w.in_transit_weeks_of_stock, 0) AS coming
  FROM spine s LEFT JOIN weeks_of_stock w USING (path)
  WHERE s.top_level_bom IS NOT NULL AND s.adjusted_procurement_intent = '@BUY@'
    AND lower(trim(COALESCE(CAST(s.is_consumable_storable AS VARCHAR), ''))) NOT IN ('t', 'true', 'y', 'yes', '1', 'on'))
SELECT DISTINCT ON (top_level_bom, rev, grp) top_level_bom, rev AS top_level_revision, grp AS system_group,
       CAST(coming AS DOUBLE) AS system_min_in_transit_weeks
FROM bought ANTI JOIN system_alternate_lines USING (path)
ORDER BY top_level_bom, rev, grp, own, part_number NULLS LAST, path NULLS LAST""",
    # supply plan: one row a part, then summed over alternates
    "planned": """
SELECT part_number, sum(IF(plan_week >= DATE '@W0@' AND plan_week < DATE '@W0p4@', quantity, 0)) AS n4,
       sum(IF(plan_week >= DATE '@W0@' AND plan_week < DATE '@W0p8@', quantity, 0)) AS n8
FROM supply_plan_rows WHERE plan_date IS NOT NULL GROUP BY ALL""",
    "supply_plan": """
SELECT part_number, done AS current_week_supply, n4 - done AS plan_total_4w, n8 - done AS plan_total_8w,
       (n4 - done) / 4.0 AS plan_avg_4w, (n8 - done) / 8.0 AS plan_avg_8w
FROM (SELECT p.*, COALESCE(s.current_week_supply, 0) AS done FROM planned p LEFT JOIN supply_this_week s USING (part_number))""",
    "supply_plan_alt": """
WITH total AS (
  SELECT b.base_part_number AS part_number, COALESCE(sum(p.n4), 0) AS n4, COALESCE(sum(p.n8), 0) AS n8
  FROM alternate_bridge b LEFT JOIN planned p ON p.part_number = b.related_part_number GROUP BY ALL)
SELECT part_number, done AS current_week_supply_alt, n4 - done AS plan_total_4w_alt, n8 - done AS plan_total_8w_alt,
       (n4 - done) / 4.0 AS plan_avg_4w_alt, (n8 - done) / 8.0 AS plan_avg_8w_alt
FROM (SELECT t.*, COALESCE(s.current_week_supply_alt, 0) AS done FROM total t LEFT JOIN supply_this_week_alt s USING (part_number))""",
}
