"""Transitive alternates and the direct-parent stock formula.

``alternate_components`` merges every alternate set that shares a part into
one component (the report's pandas path does this for its fallback columns).
Each set is a star from its parts to its first part. Large-star and small-star
steps take turns until nothing changes: every part above the smallest of its
neighbours is hung below that one, so a chain of any length shrinks by a
constant factor a round. Each round is a table that the next one reads, so
plans and size estimates start anew, and the round before is deleted. All
joins are of equals in size, merged by part: none is collected for a broadcast,
so the driver gets nothing that grows with the links or the rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kitwise.functions.text import split_part_list
from kitwise.plans.scratch import Folder


def _part_sets(rows: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    own = F.array(F.trim(F.col("part_number")))
    lists = [F.coalesce(split_part_list(F.col(c)), F.array().cast("array<string>")) for c in text_cols]
    parts = F.array_distinct(F.filter(F.concat(own, *lists), lambda x: x != F.lit("")))
    return rows.where(F.col("part_number").isNotNull()).select(parts.alias("parts"))


def _hang_large(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a part is linked to the smallest of the part and its neighbours."""
    sides = links.unionByName(links.select(F.col("low").alias("part"), F.col("part").alias("low")))
    least = sides.groupBy("part").agg(F.min("low").alias("_min")).select("part", F.least("part", "_min").alias("_min"))
    hung = sides.where(F.col("low") > F.col("part")).join(least.hint("merge"), "part")
    return hung.select(F.col("low").alias("part"), F.col("_min").alias("low")).distinct()


def _hang_small(links: DataFrame) -> DataFrame:
    """A part and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("part").agg(F.min("low").alias("_min"))
    others = links.join(least.hint("merge"), "part").where(F.col("low") != F.col("_min"))
    return least.select("part", F.col("_min").alias("low")).unionByName(
        others.select(F.col("low").alias("part"), F.col("_min").alias("low"))
    ).distinct()


def _print_of(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("part", "low"))).first())


def alternate_components(
    rows: DataFrame,
    text_cols: Sequence[str] = ("alternates_text", "global_alternate_part_numbers", "substitute_part_numbers"),
) -> DataFrame:
    """Component of every part: (part_number, component, component_size).

    ``component`` is the smallest part number of the component. Parts of
    ``rows`` that share no set with another part are their own component.
    """
    folder = Folder(rows.sparkSession, "kitwise-components")
    sets = folder.write(_part_sets(rows, text_cols), "sets")
    star = sets.select(F.explode("parts").alias("a"), F.element_at("parts", 1).alias("b")).where(F.col("a") != F.col("b"))
    links = folder.write(star.select(F.greatest("a", "b").alias("part"), F.least("a", "b").alias("low")).distinct(), "round-0")
    seen, turn = _print_of(links), 0
    while True:
        turn += 1
        following = folder.write(_hang_small(_hang_large(links)), f"round-{turn}")
        now = _print_of(following)
        folder.delete(f"round-{turn - 1}")
        links = following
        if now == seen:
            break
        seen = now
    nodes = sets.select(F.explode("parts").alias("part")).distinct()
    labels = nodes.join(links.hint("merge"), "part", "left").select("part", F.coalesce("low", "part").alias("component"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("component_size"))
    return labels.join(sizes.hint("merge"), "component").select(F.col("part").alias("part_number"), "component", "component_size")


def direct_parent_on_hand(rows: DataFrame, on_hand_col: str = "on_hand", usage_col: str = "quantity") -> DataFrame:
    """Stock held in a line's direct parent: parent on hand x line quantity.

    Only parents that occur as a child among ``rows`` count; the parent's
    on hand is the largest seen for that part. Lines without such a parent
    get 0.
    """
    children = rows.where(
        F.col("part_number").isNotNull()
        & (F.nullif(F.trim(F.col("parent_bom")), F.lit("")).isNotNull() | (F.coalesce(F.col("indent_level"), F.lit(0)) > 0))
    ).select(F.col("part_number").alias("_assembly")).distinct()
    parent_oh = (
        rows.where(F.col("part_number").isNotNull())
        .groupBy(F.col("part_number").alias("_parent"))
        .agg(F.max(F.coalesce(F.col(on_hand_col).try_cast("double"), F.lit(0.0))).alias("_parent_on_hand"))
        .join(children, F.col("_parent") == F.col("_assembly"), "left_semi")
    )
    j = rows.join(parent_oh, rows["parent_bom"] == parent_oh["_parent"], "left")
    usage = F.coalesce(F.col(usage_col).try_cast("double"), F.lit(0.0))
    return j.select(
        "path",
        "part_number",
        F.when(F.col("_parent_on_hand").isNotNull(), F.col("_parent_on_hand") * usage)
        .otherwise(F.lit(0.0))
        .alias("direct_parent_on_hand"),
    )
