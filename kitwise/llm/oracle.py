"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

MINHASH = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS} AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
  END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT x AS doc_id, x AS other FROM (SELECT DISTINCT x FROM edge)
  UNION
  SELECT reach.doc_id, edge.y FROM reach JOIN edge ON edge.x = reach.other
), comp AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
  w.doc_id = coalesce(component_id, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place, 2 * source_size AS cap FROM per
), weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM placed
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM per)::DOUBLE
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target FROM levels
), ends AS (
  SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS fin
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS full_passes FROM ends
)
SELECT doc_id, size, source_size, target,
  (full_passes * size + least(greatest(budget - full_passes * source_size - (fin - size), 0), size))::BIGINT AS taken
FROM passes
"""


def _step(x: str, cost: str, letter: str, line: str | None = None, only_if: str = "true") -> str:
    """A path one edit longer; one that is not allowed costs too much."""
    lines = f"list_append({x}.t, {line})" if line else f"{x}.t"
    return f"{{'c': {x}.c + CASE WHEN {only_if} THEN {cost} ELSE 1000000000 END, 'a': {x}.a || '{letter}', 't': {lines}}}"


def _least(*paths: str) -> str:
    return f"list_sort([{', '.join(paths)}])[1]"


_U, _A, _OWN = "'user:'", "'assistant:'", "role || ':' || text"
_MAY = "NOT gone"
_IN2 = [_step("a0", "2", "I", _U), _step("a1", "2", "I", _U)]

#: Four paths a conversation (nothing yet, system, user, assistant), each the cheapest with the least letters, row by row.
DIALOGS = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations
), harmed AS (
  SELECT n.*, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(id) + 1), lambda i: ord(id[i])::BIGINT)),
    lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS harm
  FROM named n, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN harm = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM harmed WHERE harm <> 0
), placed AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'none') AS conv, substr(role, 1, 1) AS k, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text[1:32], md5(length(role) || ':' || role || text), copy) AS pos
  FROM damaged
), flagged AS (
  SELECT *, shown = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    right(shown, 1) NOT IN ('.', '!', '?') AS cut, lag(k) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), r AS (
  SELECT *, blank OR again AS gone, (NOT blank AND NOT again AND cut)::INTEGER AS tr FROM flagged
), walk AS (
  SELECT conv, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS a0,
    {{'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS a1, a1 AS a2, a1 AS a3
  FROM (SELECT DISTINCT conv FROM r)
  UNION ALL
  SELECT conv, pos, {_step("a0", "3", "D")},
    {_least(_step("a1", "3", "D"), _step("a0", "tr", "K", _OWN, _MAY + " AND k = 's'"))},
    {_least(_step("d2", "3", "D"), *[_step(x, "tr", "K", _OWN, _MAY + " AND k = 'u'") for x in ("a0", "a1", "d3")],
            *[_step(x, "2 + tr", "R", "'user:' || text", _MAY) for x in ("a0", "a1", "d3")])},
    {_least(_step("d3", "3", "D"), _step("d2", "tr", "K", _OWN, _MAY + " AND k = 'a'"), _step("d2", "2 + tr", "R", "'assistant:' || text", _MAY))}
  FROM (
    SELECT *, {_least("c2", _step("c3", "2", "I", _U))} AS d2, {_least("c3", _step("c2", "2", "I", _A))} AS d3
    FROM (
      SELECT r.conv, r.pos, r.role, r.text, r.k, r.gone, r.tr, a0, a1,
        {_least("a2", *_IN2, _step("a3", "2", "I", _U))} AS c2, {_least("a3", _step("a2", "2", "I", _A))} AS c3
      FROM walk JOIN r ON r.conv = walk.conv AND r.pos = walk.pos + 1
    )
  )
), ended AS (
  SELECT conv, {_least("a0", "a3", _step("a2", "2", "I", _A), "b1")} AS best
  FROM (SELECT conv, a0, a2, a3, {_step("i1", "2", "I", _A)} AS b1
        FROM (SELECT *, {_step("a1", "2", "I", _U)} AS i1 FROM walk JOIN (SELECT conv, max(pos) AS pos FROM r GROUP BY conv) USING (conv, pos)))
), counted AS (
  SELECT conv_id, any_value(conv) AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, sum(tr)::BIGINT AS truncated,
    count(*) FILTER (pos > 1 AND before || k NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(array_to_string(coalesce(best.t, []), chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended USING (conv)
"""

TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL = f"""
WITH wanted AS (
  SELECT DISTINCT item, item_id, unnest(ts) AS term FROM (SELECT row_number() OVER () AS item, item_id, {TERMS} AS ts FROM benchmark)
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, {TERMS} AS ts FROM documents
), totals AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS all_terms FROM d WHERE len(ts) > 0
), tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d) SEMI JOIN wanted USING (term) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term
), scored AS (
  SELECT item, any_value(item_id) AS item_id, rid, any_value(doc_id) AS doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(ts)::BIGINT * n_docs) // all_terms))))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN w USING (term) JOIN d USING (rid), totals GROUP BY item, rid
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": TOPK, "op4_minhash": MINHASH, "op8_mixing": MIXING, "op12_dialogs": DIALOGS, "op13_lexical": LEXICAL}
