"""Alternate (interchangeable) parts (stages D1-D6).

An alternate group is one row of comma-separated part numbers; its id is the
row id. The related set of a part is every part of every group it is in
(itself included), or just itself when it is in no group.

Sums over the related set (``sum_over_alternates``) do not build the pair
list. Parts with the same set of groups have the same related set, so they form
one class; figures are summed per class, then over the classes that share a
group with it. Groups may overlap in any way: a class is counted once however
many groups it shares.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alternate_groups(sheet: DataFrame, text_col: str = "part_numbers", id_col: str = "row_id") -> DataFrame:
    """Distinct (group, position, trimmed part); blanks dropped, positions kept."""
    exploded = sheet.select(
        F.col(id_col).alias("group_id"), F.posexplode(F.split(F.col(text_col), ",")).alias("part_index", "_item")
    )
    return (
        exploded.select("group_id", "part_index", F.trim(F.col("_item")).alias("part_number"))
        .where(F.col("part_number") != "")
        .distinct()
    )


def directed_bridge(groups: DataFrame) -> DataFrame:
    """The part at position 0 of a group to every part of it (itself too)."""
    first = groups.where(F.col("part_index") == 0).select(
        "group_id", F.col("part_number").alias("base_part_number")
    )
    members = groups.select("group_id", F.col("part_number").alias("related_part_number"))
    return first.join(members, "group_id").select("base_part_number", "related_part_number").distinct()


def _members(groups: DataFrame) -> DataFrame:
    return groups.select("group_id", "part_number").distinct()


def alternate_bridge(base: DataFrame, groups: DataFrame) -> DataFrame:
    """Each base part to every part of every group it is in (or itself).

    This is the pair list itself; its size is the sum over base parts of the
    related-set sizes. Aggregations use ``sum_over_alternates`` instead.
    """
    b = base.select("part_number").distinct()
    mem = _members(groups)
    g = b.join(mem, "part_number", "left")
    rel = mem.select("group_id", F.col("part_number").alias("_rel"))
    return (
        g.join(rel, "group_id", "left")
        .select(
            F.col("part_number").alias("base_part_number"),
            F.coalesce(F.col("_rel"), F.col("part_number")).alias("related_part_number"),
        )
        .distinct()
    )


def alternates_text(base: DataFrame, groups: DataFrame) -> DataFrame:
    """Sorted, ', '-joined related parts other than the part itself ('' if none).

    Each group's members are one array; a part puts together the arrays of its
    own groups, so no pair list is made.
    """
    mem = _members(groups)
    lists = mem.groupBy("group_id").agg(F.collect_set("part_number").alias("_parts"))
    per = base.select("part_number").distinct().join(mem, "part_number").join(lists, "group_id")
    per = per.groupBy("part_number").agg(F.array_distinct(F.flatten(F.collect_list("_parts"))).alias("_parts"))
    others = F.filter(F.col("_parts"), lambda x: x != F.col("part_number"))
    text = F.coalesce(F.array_join(F.sort_array(others), ", "), F.lit(""))
    return base.select("part_number").join(per, "part_number", "left").select("part_number", text.alias("alternates_text"))


def alternate_classes(groups: DataFrame) -> DataFrame:
    """(part_number, class) of every part in a group: parts with the same set of groups are one class.

    A class is named by a hash of its groups.
    """
    per = _members(groups).groupBy("part_number").agg(F.sort_array(F.collect_set("group_id")).alias("_groups"))
    return per.select("part_number", F.md5(F.to_json("_groups").cast("binary")).alias("class"))


def class_links(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, other): classes that share a group, each with itself too.

    The parts of a group that are in no other are one class, so a group of
    any size has as many classes as there are ways in which it overlaps others.
    """
    held = _members(groups).join(classes, "part_number").select("group_id", "class").distinct()
    return held.join(held.select("group_id", F.col("class").alias("other")), "group_id").select("class", "other").distinct()


def sum_over_alternates(
    base: DataFrame,
    groups: DataFrame,
    metrics: DataFrame,
    columns: Sequence[str],
    key: str = "part_number",
    classes: DataFrame | None = None,
    links: DataFrame | None = None,
) -> DataFrame:
    """Sum ``columns`` of ``metrics`` over each base part's related set.

    ``metrics`` has at most one row per ``key``. A related part without a
    metrics row adds 0; a NULL value is skipped as SQL ``SUM`` does. Returns
    one row per distinct base part. Pass ``classes`` and ``links``
    (``alternate_classes``, ``class_links``) to reuse them.
    """
    classes = classes if classes is not None else alternate_classes(groups)
    links = links if links is not None else class_links(groups, classes)
    m = metrics.select(F.col(key).alias("part_number"), *columns, F.lit(True).alias("_present"))
    filled = [F.when(F.col("_present").isNull(), F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in columns]
    totals = classes.join(m, "part_number", "left").select("class", *filled)
    totals = totals.groupBy(F.col("class").alias("other")).agg(*[F.sum(c).alias(c) for c in columns])
    sums = links.join(totals, "other").groupBy("class").agg(*[F.sum(c).alias(c) for c in columns])
    parts = base.select("part_number").distinct()
    # parts without a group would all meet on one NULL class
    grouped = parts.join(classes, "part_number").join(sums, "class").select("part_number", *columns)
    alone = parts.join(classes, "part_number", "left_anti").join(m, "part_number", "left").select("part_number", *filled)
    return grouped.unionByName(alone)


def alternates_of(parts: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct parts (``part_number``) that are an alternate of some other part of ``parts``; no pairs are made."""
    mem = _members(groups)
    named = parts.select("part_number").distinct().join(mem, "part_number")
    named = named.groupBy("group_id").agg(F.count("*").alias("_n"), F.min("part_number").alias("_only"))
    others = mem.join(named, "group_id").where((F.col("_n") > 1) | (F.col("part_number") != F.col("_only")))
    return others.select("part_number").distinct()


def latest_over_alternates(base: DataFrame, groups: DataFrame, latest: DataFrame, order_col: str) -> DataFrame:
    """Largest ``order_col`` struct over each base part's related set.

    ``latest`` has one row per part with a struct column ``order_col``. A max
    needs no de-duplication, so it goes part -> group max -> base max. Parts
    without any related row are absent from the result.
    """
    mem = _members(groups)
    group_max = mem.join(latest, "part_number").groupBy("group_id").agg(F.max(order_col).alias(order_col))
    b = base.select("part_number").distinct()
    via_groups = b.join(mem, "part_number").join(group_max, "group_id").select("part_number", order_col)
    alone = b.join(mem, "part_number", "left_anti").join(latest, "part_number").select("part_number", order_col)
    return via_groups.unionByName(alone).groupBy("part_number").agg(F.max(order_col).alias(order_col))
