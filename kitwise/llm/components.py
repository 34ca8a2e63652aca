"""Connected components by alternating large-star and small-star.

Both steps are joins and aggregates with map-side partial minima, so a node
with very many neighbours is never one task: the aggregate pre-combines, and
the join's skewed side can be split. Each round is one written table; the one
before it is deleted. The loop ends when a round changes nothing, with no cap
on the number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reached.

    Null ends, self links and repeated links count for nothing. Nodes without
    a link are not in the result. Without links the result is empty.
    """
    start = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    table = f"{name}-0"
    now = scratch.save(start.distinct(), table)
    state, turn = _state(now), 0
    while state[0]:
        turn += 1
        following = scratch.save(_small_star(_large_star(now)), f"{name}-{turn}")
        reached = _state(following)
        scratch.drop(table)
        now, table = following, f"{name}-{turn}"
        if reached == state:
            break
        state = reached
    # now a star forest: every node but the smallest of its component points at that one
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
