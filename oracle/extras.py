"""Oracle SQL for the extra queries (recursive CTE for the components)."""

from __future__ import annotations

from kitwise.plans.extras import SCHEMAS
from oracle.stages import STAGES, stage_sql

_SPLIT = "list_filter(list_transform(string_split(COALESCE({c}, ''), ','), lambda x: trim(x)), lambda x: x <> '')"

STAGES["extra_part_sets"] = f"""
SELECT list_distinct(list_filter(list_concat([trim(s.part_number)],
         {_SPLIT.format(c='atx.alternates_text')},
         {_SPLIT.format(c='s.global_alternate_part_numbers')},
         {_SPLIT.format(c='s.substitute_part_numbers')}), lambda x: x <> '')) AS parts
FROM spine s LEFT JOIN alternates_text atx ON s.part_number = atx.part_number
WHERE s.part_number IS NOT NULL"""

STAGES["alternate_components"] = """
WITH RECURSIVE
  members AS (SELECT DISTINCT unnest(parts) AS node, parts FROM extra_part_sets),
  edges AS (SELECT DISTINCT m1.node AS a, m2.node AS b FROM members m1 JOIN members m2 ON m1.parts = m2.parts
            WHERE len(m1.parts) > 1),
  reach(node, other) AS (
    SELECT node, node FROM members
    UNION
    SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
  ),
  labels AS (SELECT node, min(other) AS component FROM reach GROUP BY node)
SELECT l.node AS part_number, l.component, c.n AS component_size
FROM labels l JOIN (SELECT component, count(*) AS n FROM labels GROUP BY component) c ON l.component = c.component"""

STAGES["direct_parent_on_hand"] = """
SELECT s.path, s.part_number,
       CASE WHEN po.on_hand IS NOT NULL THEN po.on_hand * COALESCE(CAST(s.quantity AS DOUBLE), 0) ELSE 0 END AS direct_parent_on_hand
FROM (SELECT sp.*, im.on_hand AS line_on_hand FROM spine sp LEFT JOIN inventory_by_part im ON sp.part_number = im.part_number) s
LEFT JOIN (
  SELECT x.part_number, MAX(COALESCE(x.line_on_hand, 0)) AS on_hand
  FROM (SELECT sp.part_number, im.on_hand AS line_on_hand FROM spine sp LEFT JOIN inventory_by_part im ON sp.part_number = im.part_number) x
  WHERE x.part_number IS NOT NULL
    AND x.part_number IN (SELECT part_number FROM spine c
                          WHERE c.part_number IS NOT NULL
                            AND (NULLIF(TRIM(c.parent_bom), '') IS NOT NULL OR COALESCE(c.indent_level, 0) > 0))
  GROUP BY x.part_number
) po ON s.parent_bom = po.part_number"""

# parts of a path with inline revisions are split, stripped of them and joined; other paths lose revision segments
STAGES["plain_path_inline"] = r"""
WITH paths AS (
  SELECT path, list_filter(string_split(regexp_replace(path, ':REV[A-Za-z0-9]+', '', 'g'), '|'), lambda x: x <> '') AS parts
  FROM (SELECT path FROM in_bom
        UNION ALL SELECT regexp_replace(path, '[|]([A-Za-z][A-Za-z0-9]{0,2})[|]', ':REV\1|', 'g') FROM in_bom))
SELECT path, IF(regexp_matches(path, ':REV[A-Za-z0-9]'), array_to_string(parts, '|'),
                regexp_replace(regexp_replace(path, '[|][A-Za-z][A-Za-z0-9]{0,2}[|]', '|', 'g'), '[|]+', '|', 'g')) AS plain_path
FROM paths"""

# the same shipments, as plain columns
STAGES["in_transit_row_objects"] = "SELECT part_number, in_transit_quantity FROM in_transit"

# sums by root, the largest picked by a window
STAGES["rows_rollup"] = """
WITH below AS (
  SELECT DISTINCT part_number FROM spine
  WHERE length(trim(COALESCE(parent_bom, ''))) > 0 OR indent_level > 0),
bought AS (
  SELECT part_number, SUM(COALESCE(adjusted_quantity, 0)) AS amount
  FROM spine
  WHERE adjusted_procurement_intent = '@BUY@' AND part_number IS NOT NULL
    AND top_level_bom IS NOT NULL AND top_level_bom NOT IN (SELECT part_number FROM below WHERE part_number IS NOT NULL)
  GROUP BY part_number, top_level_bom, COALESCE(top_level_revision, '')),
most AS (
  SELECT part_number, amount FROM bought
  QUALIFY row_number() OVER (PARTITION BY part_number ORDER BY amount DESC) = 1)
SELECT s.path, s.part_number, s.top_level_bom, m.amount AS total_rolled_up_quantity
FROM spine s LEFT JOIN most m USING (part_number)"""


def oracle_sql() -> dict[str, str]:
    return {name: stage_sql(name, schema) for name, schema in SCHEMAS.items()}
