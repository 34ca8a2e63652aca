"""Exact top-k by inner product with a pivot table.

Vectors are floor(scale * x) integers. Each vector's distances to many pivots
are computed once (the pivot table). For a query q and a candidate x,
|d(q,p) - d(x,p)| bounds their distance from below for every pivot p; the
largest such bound gives an upper bound of the score,
q.x <= (|q|^2 + |x|^2 - bound^2) / 2. Candidates lie in cells (nearest centre,
the first pivots), hot cells are dealt over blocks of bounded size, and so are
the queries.

1. Each query is evaluated in one block of its own cell: its k-th best score
   there is a floor that no final answer falls below.
2. The query then goes to every cell whose ring of pivot distances allows a
   score of at least the floor. A block evaluates candidates in the order of
   their bounds, in slices, and stops when no bound left reaches the k-th best
   score so far. Slices are matrix products of a tile of queries.
3. The k best of all blocks' answers are the result, ties to the smaller id.

The pivots are vectors of the table, picked by farthest-first traversal of a
bounded sample (``sample`` rows with the smallest id hashes); any choice gives
the same answer. Bounds are widened for rounding, scores are exact: float
products are used only where every partial sum is an exact integer, Python
integers otherwise, and scores beyond a long are held at its ends.

Edge cases: vectors that are null, or hold null or non-finite components, and
rows with a null id take no part. Shorter vectors count as padded with zeros.
Rows that repeat an id are candidates each; a query's own id is never its
candidate, and a query id that repeats is one query for each different vector's
smallest copy (see ``top_k``). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch

_LONG = np.iinfo(np.int64)


def _matrix(vectors, dim: int) -> np.ndarray:
    """Rows of integers as float64, or as Python integers if floats can't hold their products."""
    m = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    return m


def _exact(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The operands in the cheapest type whose products and sums are exact."""
    if not (q.size and x.size):
        return q, x
    worst = np.abs(q).max() * np.abs(x).max() * q.shape[1]
    if worst < 1 << 24:
        return q.astype(np.float32), x.astype(np.float32)
    if worst < 1 << 53:
        return q, x
    return np.vectorize(int, otypes=[object])(q), np.vectorize(int, otypes=[object])(x)


def _distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (m @ pivots.T)
    return np.sqrt(np.maximum(d, 0))


def _slack(d: np.ndarray) -> float:
    """How far rounding may move a distance."""
    return 1e-5 * (1.0 + (float(np.abs(d).max()) if d.size else 0.0))


def _pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal from the first row."""
    chosen, gap = [0], _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _with_pivots(pivots: np.ndarray, centres: int, dim: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lo in range(0, len(part), 4096):
                rows = part.iloc[lo : lo + 4096]
                d = _distances(_matrix(rows["v"].to_list(), dim), pivots)
                yield rows.assign(cell=d[:, :centres].argmin(1).astype(np.int32), dist=list(d))

    return run


def _rings(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each part, each cell's size, its largest squared length, and its least and largest distance to every pivot."""
    for part in parts:
        for cell, rows in part.groupby("cell"):
            d = np.stack(rows["dist"].to_list())
            norm2 = max(float(np.dot(v, v)) for v in rows["v"])
            yield pd.DataFrame(
                {"cell": [cell], "n": [len(rows)], "n_queries": [int(rows["is_query"].sum())], "norm2": [norm2], "lo": [d.min(0)], "hi": [d.max(0)]}
            )


def _reach(cells: np.ndarray, n_blocks: np.ndarray, norm2: np.ndarray, lo: np.ndarray, hi: np.ndarray, dim: int):
    """Each query once for every block of every cell that may hold a score of its floor or more."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            d, q = np.stack(part["dist"].to_list()), _matrix(part["v"].to_list(), dim)
            floor = part["floor"].to_numpy(np.float64, na_value=np.nan)
            for c in range(len(cells)):
                gap = np.maximum(np.maximum(lo[c] - d, d - hi[c]).max(1), 0)
                gap = np.maximum(gap - _slack(d), 0)
                upper = ((q * q).sum(1) + norm2[c] - gap * gap) / 2
                go = np.isnan(floor) | (upper + 1e-6 * (1 + np.abs(upper)) >= floor)
                for b in range(int(n_blocks[c])):
                    yield part[go].assign(cell=cells[c], block=np.int32(b))

    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores.astype(np.float64) if scores.dtype == object else -scores))
    if scores.dtype == object:  # floats may merge large integers
        order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), dtype=np.int64)
    return scores[order[:k]], ids[order[:k]]


def _search_tile(qid, q, qd, qfloor, xid, x, xd, k: int, slice_size: int) -> list[tuple]:
    """The answers of one block for a tile of queries."""
    norm_q, norm_x = (q * q).sum(1), (x * x).sum(1)
    low = np.zeros((len(q), len(x)), np.float32)
    dq, dx = qd.astype(np.float32), np.ascontiguousarray(xd.T.astype(np.float32))
    for p in range(dx.shape[0]):
        np.maximum(low, np.abs(dq[:, p, None] - dx[None, p]), out=low)
    low = np.maximum(low - _slack(dx) - _slack(dq), 0).astype(np.float64)
    upper = (norm_q[:, None] + norm_x[None] - low * low) / 2
    upper += 1e-6 * (1 + np.abs(upper))
    best_s = [np.zeros(0, np.int64)] * len(q)
    best_i = [np.zeros(0, np.int64)] * len(q)
    floor = qfloor.copy()
    order = np.argsort(-(upper - floor[:, None]).max(0) if np.isfinite(floor).all() else -upper.max(0), kind="stable")
    for at in range(0, len(x), slice_size):
        left = order[at:]
        if not (upper[:, left] >= floor[:, None]).any():
            break  # no candidate left can reach any query's k-th best
        now = left[:slice_size]
        a, b = _exact(q, x[now])
        scores = a @ b.T
        keep = (scores >= floor[:, None]) & (xid[now][None] != qid[:, None])
        for i in np.flatnonzero(keep.any(1)):
            hit = keep[i]
            s = scores[i, hit]
            s = s if s.dtype == object else s.astype(np.int64)
            best_s[i], best_i[i] = _best(np.concatenate((best_s[i], s)), np.concatenate((best_i[i], xid[now][hit])), k)
            if len(best_s[i]) == k:
                floor[i] = max(floor[i], float(best_s[i][-1]))
    return [
        (qid[i], best_i[i][j], min(max(int(best_s[i][j]), _LONG.min), _LONG.max))
        for i in range(len(q))
        for j in range(len(best_s[i]))
    ]


def _search(k: int, dim: int, tile: int, slice_size: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(rows):
            x, xd = _matrix(rows["v"].to_list(), dim), np.stack(rows["dist"].to_list())
            xid = rows["vec_id"].to_numpy(np.int64)
            for lo in range(0, len(queries), tile):
                part = queries.iloc[lo : lo + tile]
                q, qd = _matrix(part["v"].to_list(), dim), np.stack(part["dist"].to_list())
                floor = part["floor"].to_numpy(np.float64, na_value=-np.inf)
                out += _search_tile(part["vec_id"].to_numpy(np.int64), q, qd, floor, xid, x, xd, k, slice_size)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    scale: float = 64.0,
    n_pivots: int = 32,
    n_centres: int = 16,
    sample: int = 1024,
    block_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """Each query's k best rows other than its own: (query_id, rank, vec_id, score).

    ``is_query`` picks the queries by ``id_col``. An id that repeats with
    several vectors asks once, with the smallest of them; all its rows are
    candidates for others. Fewer than k other rows: all of them.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    out_type = "query_id long, vec_id long, score long"
    quantised = F.transform(F.col(vector_col), lambda x: F.floor(F.col("scale") * x.cast("double")).cast("double"))
    whole = ~F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col), F.lit(float(scale)).alias("scale"), is_query.alias("is_query"))
        .where(F.col("vec_id").isNotNull() & F.col(vector_col).isNotNull() & whole)
        .select("vec_id", quantised.alias("v"), F.coalesce("is_query", F.lit(False)).alias("is_query"))
    )
    rows = scratch.save(rows, "rows")
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if not dim:  # no vectors, or only empty ones: every score is 0
        dim = 1
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").toPandas()["v"]
    if not len(picked):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = _pick_pivots(_matrix(picked.to_list(), dim), n_pivots)
    centres = min(n_centres, len(pivots))

    table = rows.mapInPandas(
        _with_pivots(pivots, centres, dim), "vec_id long, v array<double>, is_query boolean, cell int, dist array<double>"
    )
    table = scratch.save(table, "table")
    # the cells' sizes and rings: n_centres x n_pivots rows
    partial = table.mapInPandas(_rings, "cell int, n long, n_queries long, norm2 double, lo array<double>, hi array<double>")
    ring = partial.select("cell", "n", "n_queries", "norm2", F.posexplode(F.arrays_zip("lo", "hi")).alias("pivot", "x"))
    ring = ring.groupBy("cell", "pivot").agg(
        *[F.sum(c).alias(c) for c in ("n", "n_queries")], F.max("norm2").alias("norm2"), F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi")
    )
    ring = ring.toPandas().sort_values(["cell", "pivot"])
    rings = ring.groupby("cell").agg({"n": "first", "n_queries": "first", "norm2": "first", "lo": list, "hi": list}).reset_index()
    n_blocks = {int(c): max(1, -(-int(n) // block_rows)) for c, n in zip(rings["cell"], rings["n"], strict=True)}
    chunks = max(1, -(-int(rings["n_queries"].sum()) // query_rows))
    salt = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    blocks_of = F.create_map(*[F.lit(x) for c, n in n_blocks.items() for x in (c, n)])
    block = salt(blocks_of[F.col("cell")].cast("long"))
    asked = scratch.read("table", table.schema).withColumn("block", block)
    table = table.withColumn("block", block)
    asked = asked.where("is_query").withColumn("chunk", salt(F.lit(chunks)))
    once = Window.partitionBy("vec_id").orderBy("v")
    asked = asked.withColumn("rn", F.row_number().over(once)).where("rn = 1").drop("rn")
    candidates = table.select("vec_id", "v", "dist", "cell", "block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    run = _search(k, dim, 64, 1024)

    def search(queries: DataFrame) -> DataFrame:
        keys = ["cell", "block", "chunk"]
        return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(run, out_type)

    # 1. a floor for each query, from one block of its own cell
    first = scratch.save(search(asked.withColumn("floor", F.lit(None).cast("double"))), "first")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    asked = asked.join(floors.select(F.col("query_id").alias("vec_id"), F.col("floor").cast("double")), "vec_id", "left")

    # 2. every cell that the rings don't rule out
    allowed = _reach(
        rings["cell"].to_numpy(np.int32),
        np.array([n_blocks[int(c)] for c in rings["cell"]]),
        rings["norm2"].to_numpy(float),
        np.stack(rings["lo"].to_list()),
        np.stack(rings["hi"].to_list()),
        dim,
    )
    columns = "vec_id long, v array<double>, dist array<double>, floor double, chunk int, cell int, block int"
    found = search(asked.select("vec_id", "v", "dist", "floor", "chunk").mapInPandas(allowed, columns))

    # 3. the best of all blocks
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    out = scratch.save(out.select("query_id", "rank", "vec_id", "score"), "result")
    scratch.keep_only("result")
    return out
