"""Spark-against-DuckDB comparison, the same checks the driver makes.

Row count, column names, and the multiset of rows (columns sorted by name,
values as text, rows sorted) must all agree.
"""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 4) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the oracle (empty if equal)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns differ: spark-only {set(s_cols) - set(o_cols)}, oracle-only {set(o_cols) - set(s_cols)}")
        return problems
    if len(s_rows) != len(o_rows):
        problems.append(f"row count spark {len(s_rows)} oracle {len(o_rows)}")
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    if a != b:
        sa, sb = set(a), set(b)
        only_s = sorted(sa - sb)[:3]
        only_o = sorted(sb - sa)[:3]
        cols = sorted(s_cols)
        problems.append(f"values differ ({len(sa - sb)} spark-only, {len(sb - sa)} oracle-only); cols={cols}")
        for r in only_s:
            problems.append(f"  spark : {r}")
        for r in only_o:
            problems.append(f"  oracle: {r}")
    return problems
