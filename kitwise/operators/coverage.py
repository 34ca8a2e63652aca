"""Weeks of stock (stages J2-J8).

Each line covers the weeks from the as-of week to its last demand week (at
most ``max_week_offset``). The weekly and running demand of a part is one
bounded array per part. Lines are dealt by part once, as narrow rows, meet that
array there and are spread into weeks where they are; rows of weeks are never
shuffled, joined or windowed.

Stock is used up path by path. A part whose lines have both a NULL and an ''
revision has two demands in a week, and a path that several parts or revisions
share has the demands of all its lines; only such shared paths are numbered
week by week. Within a week the report leaves the order open. Here lines
follow each other by the MD5 digest of part and revision, then NULL before ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kitwise.functions.dates import week_offset
from kitwise.functions.math import coverage, coverage_in_transit
from kitwise.functions.text import not_text_true, text_key
from kitwise.params import ReportParams


def demand_horizon(spine: DataFrame, last_week: DataFrame, p: ReportParams) -> DataFrame:
    """Last demand week offset per (path, part, revision), clipped to [0, max]."""
    lw = last_week.select(
        F.col("part_number").alias("_lw_part"), F.col("revision_key").alias("_lw_key"), "last_demand_week"
    )
    lines = spine.where(F.col("part_number").isNotNull() & F.col("path").isNotNull()).select(
        "path", "part_number", "revision"
    )
    j = lines.join(
        lw, (lines["part_number"] == lw["_lw_part"]) & (text_key(lines["revision"]) == lw["_lw_key"]), "left"
    )
    last = F.coalesce(F.max(week_offset(F.col("last_demand_week"), p.week0)), F.lit(0))
    return j.groupBy("path", "part_number", "revision").agg(
        F.least(F.lit(p.max_week_offset), F.greatest(F.lit(0), last)).alias("max_week_offset")
    )


def shared_paths(spine: DataFrame) -> DataFrame:
    """Paths of lines that differ in part or revision, of which a sound hierarchy has none."""
    line = F.struct("part_number", "revision")
    return (
        spine.where(F.col("part_number").isNotNull() & F.col("path").isNotNull())
        .groupBy("path")
        .agg(F.min(line).alias("_least"), F.max(line).alias("_most"))
        .where(~F.col("_least").eqNullSafe(F.col("_most")))
        .select("path")
    )


def weekly_demand_map(remaining: DataFrame, p: ReportParams) -> DataFrame:
    """Remaining demand per (part, revision key) as an array of its weeks 0..last (at most ``max_week_offset``).

    An entry has the week's offset, its demand and the demand of all entries
    before it. A week has one entry, or two where the part occurs with a NULL
    and an '' revision (in this order); weeks without demand have 0. Demand
    that is dealt by part, as its stage gives it, is not shuffled again.
    """
    off = week_offset(F.col("demand_week"), p.week0)
    entry = F.struct(off.alias("week"), F.col("revision").isNotNull().alias("is_text"), F.col("week_demand").alias("demand"))
    found = (
        remaining.where(F.col("demand_week") <= F.lit(p.week(p.max_week_offset)))
        .groupBy("part_number", text_key(F.col("revision")).alias("revision_key"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_found"))
    )
    weeks = F.sequence(F.lit(0), F.element_at("_found", -1)["week"])
    none = F.transform(
        F.array_except(weeks, F.col("_found.week")),
        lambda w: F.struct(w.alias("week"), F.lit(False).alias("is_text"), F.lit(0.0).alias("demand")),
    )
    filled = found.select("part_number", "revision_key", "_found", none.alias("_none"))
    filled = filled.select(
        "part_number",
        "revision_key",
        F.when(F.size("_none") == 0, F.col("_found")).otherwise(F.sort_array(F.concat("_found", "_none"))).alias("_weeks"),
    )
    entries = F.zip_with("_weeks", _running(F.col("_weeks.demand")), lambda e, prior: _week(e["week"], e["demand"], prior))
    return filled.select("part_number", "revision_key", entries.alias("demand_by_week"))


def _week(week: Column, demand: Column, prior: Column) -> Column:
    return F.struct(week.alias("week_offset"), demand.alias("week_demand"), prior.alias("prior_demand"))


def _running(demands: Column) -> Column:
    """For each demand of the array the sum of those before it."""
    start = F.struct(F.lit(0.0).alias("run"), F.array().cast("array<double>").alias("prior"))
    return F.aggregate(
        demands,
        start,
        lambda acc, x: F.struct((acc["run"] + x).alias("run"), F.concat(acc["prior"], F.array(acc["run"])).alias("prior")),
    )["prior"]


def _with_weeks(lines: DataFrame, demand_map: DataFrame) -> DataFrame:
    """``lines`` with ``weeks``: the entries of the part's weeks 0..``max_week_offset``, 0 after its last."""
    # by part alone, as both sides are dealt: one row with the arrays of all revisions of a part
    revisions = F.map_from_entries(F.collect_list(F.struct("revision_key", "demand_by_week")))
    dm = demand_map.groupBy(F.col("part_number").alias("_dm_part")).agg(revisions.alias("_revisions"))
    j = lines.join(dm, lines["part_number"] == dm["_dm_part"], "left")
    j = j.withColumn("demand_by_week", F.try_element_at("_revisions", text_key(F.col("revision"))))
    known, horizon = F.col("demand_by_week"), F.col("max_week_offset")
    last = F.try_element_at(known, F.lit(-1))
    last_week = F.coalesce(last["week_offset"], F.lit(-1))
    total = F.coalesce(last["prior_demand"] + last["week_demand"], F.lit(0.0))
    later = F.transform(F.sequence(last_week + 1, horizon), lambda w: _week(w, F.lit(0.0), total))
    weeks = (
        F.when(last_week == horizon, known)
        .when(known.isNull(), later)
        .when(last_week < horizon, F.concat(known, later))
        .otherwise(F.filter(known, lambda e: e["week_offset"] <= horizon))
    )
    return j.select(*lines.columns, weeks.alias("weeks"))


def shared_path_demand(needs: DataFrame, shared: DataFrame) -> DataFrame:
    """The demand before each entry of lines that share their path with other lines.

    ``needs`` has (path, part_number, revision) and the array ``weeks``; the
    result has the array ``shared_prior`` instead, of the same length. A path's
    entries are in order of week, then line. The lines of a path and week are
    dealt into 4096 blocks by the first digits of their digest: block sums are
    added up along the path (at most 104 x 4096 a path), and entries within
    their block, so however many lines a path has no task gets them all.
    """
    entry = F.posexplode("weeks").alias("_nth", "_entry")
    rows = needs.join(shared, "path", "left_semi").select(
        "path",
        "part_number",
        "revision",
        F.md5(F.concat_ws("|", "part_number", text_key(F.col("revision"))).cast("binary")).alias("_digest"),
        entry,
    )
    rows = rows.select(
        "path", "part_number", "revision", "_digest", F.substring("_digest", 1, 3).alias("_block"), "_nth",
        F.col("_entry.week_offset").alias("_week"), F.col("_entry.week_demand").alias("_demand"),
    )
    block = ["path", "_week", "_block"]
    along = Window.partitionBy("path").orderBy("_week", "_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*block).agg(F.sum("_demand").alias("_sum"))
    before = sums.select(*block, F.coalesce(F.sum("_sum").over(along), F.lit(0.0)).alias("_before"))
    inside = (
        Window.partitionBy(*block)
        .orderBy("_digest", "part_number", F.col("revision").asc_nulls_first(), "_nth")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("_inside", F.coalesce(F.sum("_demand").over(inside), F.lit(0.0))).join(before, block)
    priors = F.array_sort(F.collect_list(F.struct("_nth", (F.col("_before") + F.col("_inside")).alias("prior"))))
    return placed.groupBy("path", "part_number", "revision").agg(priors["prior"].alias("shared_prior"))


def line_weeks(
    horizon: DataFrame,
    shared: DataFrame,
    demand_map: DataFrame,
    inv_alt: DataFrame,
    parent_stock: DataFrame,
    transit_alt: DataFrame,
) -> DataFrame:
    """J3-J5 per line: its stock figures and the array ``weeks`` of weeks 0..horizon.

    An entry of ``weeks`` has the week's offset, its demand and the demand of
    all entries before it. The path-keyed lookups come first, then those by
    part, the weeks last, so rows with weeks are not shuffled; the demand before
    the entries of a shared path comes from ``shared_path_demand``.
    """
    on_shared = shared_path_demand(_with_weeks(horizon.join(shared, "path", "left_semi"), demand_map), shared).select(
        F.col("path").alias("_sh_path"),
        F.col("part_number").alias("_sh_part"),
        F.col("revision").alias("_sh_rev"),
        "shared_prior",
    )
    j = (
        horizon.join(parent_stock.select("path", "on_hand_in_parents"), "path", "left")
        .join(
            on_shared,
            (F.col("path") == F.col("_sh_path"))
            & (F.col("part_number") == F.col("_sh_part"))
            & F.col("revision").eqNullSafe(F.col("_sh_rev")),
            "left",
        )
        .join(inv_alt.select("part_number", "on_hand_alt"), "part_number", "left")
        .join(transit_alt.select("part_number", "in_transit_alt"), "part_number", "left")
    )
    stock = F.coalesce(F.col("on_hand_alt"), F.lit(0.0)) + F.coalesce(F.col("on_hand_in_parents"), F.lit(0.0))
    transit = F.coalesce(F.col("in_transit_alt"), F.lit(0.0))
    own = j.select(
        "path",
        "part_number",
        "revision",
        "max_week_offset",
        stock.alias("stock"),
        (stock + transit).alias("stock_with_in_transit"),
        transit.alias("in_transit"),
        "shared_prior",
    )
    placed = F.zip_with("weeks", "shared_prior", lambda e, prior: _week(e["week_offset"], e["week_demand"], prior))
    weeks = F.when(F.col("shared_prior").isNull(), F.col("weeks")).otherwise(placed)
    kept = ("path", "part_number", "revision", "stock", "stock_with_in_transit", "in_transit")
    return _with_weeks(own, demand_map).select(*kept, weeks.alias("weeks"))


def _by_week(lines: DataFrame) -> DataFrame:
    """One row per line and entry of ``weeks``, with the covered fractions of the week."""
    rows = lines.select(
        "path", "part_number", "revision", "stock", "stock_with_in_transit", "in_transit", F.explode("weeks").alias("_w")
    ).select("*", "_w.*").drop("_w")
    prior, demand = F.col("prior_demand"), F.col("week_demand")
    return rows.select(
        "*",
        coverage(F.col("stock"), prior, demand).alias("week_coverage"),
        coverage(F.col("stock_with_in_transit"), prior, demand).alias("week_coverage_with_in_transit"),
        coverage_in_transit(F.col("in_transit"), prior, demand).alias("week_coverage_in_transit"),
    )


def weekly_coverage(lines: DataFrame, p: ReportParams) -> DataFrame:
    """J3-J5 as rows: one per line, week 0..horizon and demand of the week."""
    return _by_week(lines).select(
        "path",
        "part_number",
        "revision",
        F.date_add(F.lit(p.week0), F.col("week_offset") * 7).alias("demand_week"),
        "stock",
        "stock_with_in_transit",
        "in_transit",
        "week_offset",
        "week_demand",
        "prior_demand",
        "week_coverage",
        "week_coverage_with_in_transit",
        "week_coverage_in_transit",
    )


def weeks_of_stock(lines: DataFrame) -> DataFrame:
    """Weeks of stock per (path, part, revision): the sum of covered fractions.

    ``lines`` is dealt by part, so each line's weeks are summed where they are made.
    """
    return (
        _by_week(lines)
        .groupBy("path", "part_number", "revision")
        .agg(
            F.sum("week_coverage").cast("double").alias("weeks_of_stock"),
            F.sum("week_coverage_with_in_transit").cast("double").alias("weeks_of_stock_with_in_transit"),
            F.sum("week_coverage_in_transit").cast("double").alias("in_transit_weeks_of_stock"),
        )
    )


def system_alternate_lines(spine: DataFrame, directed: DataFrame) -> DataFrame:
    """Lines whose part is a directed alternate of a part in the same root and system."""

    def keys(df: DataFrame, part: str) -> DataFrame:
        return df.select(
            F.col("part_number").alias(part),
            F.col("top_level_bom").alias("_root"),
            text_key(F.col("top_level_revision")).alias("_key"),
            text_key(F.col("system")).alias("_sys"),
        )

    originals = keys(spine, "base_part_number").distinct()
    alt_keys = (
        originals.join(directed.where(F.col("related_part_number") != F.col("base_part_number")), "base_part_number")
        .select(F.col("related_part_number").alias("part_number"), "_root", "_key", "_sys")
        .distinct()
    )
    lines = spine.select(
        "path",
        "part_number",
        F.col("top_level_bom").alias("_root"),
        text_key(F.col("top_level_revision")).alias("_key"),
        text_key(F.col("system")).alias("_sys"),
    )
    return lines.join(alt_keys, ["part_number", "_root", "_key", "_sys"], "left_semi").select("path").distinct()


def system_min_weeks(spine: DataFrame, wos: DataFrame, alt_lines: DataFrame, p: ReportParams) -> DataFrame:
    """In-transit weeks of the line with the fewest weeks of stock per (root, rev, system).

    Alternates, non-bought and consumable lines are left out. The pick is a
    ``min`` over a struct in the ranking order, so it aggregates map-side.
    """
    lines = spine.where(
        F.col("top_level_bom").isNotNull()
        & (F.col("adjusted_procurement_intent") == p.buy_intent)
        & not_text_true(F.col("is_consumable_storable"))
    ).join(alt_lines, "path", "left_anti")
    j = lines.join(
        wos.select("path", "weeks_of_stock", "in_transit_weeks_of_stock"), "path", "left"
    )
    ranked = F.struct(
        F.coalesce(F.col("weeks_of_stock"), F.lit(0.0)).alias("w"),
        F.col("part_number").isNull().alias("part_null"),
        F.col("part_number").alias("part"),
        F.col("path").isNull().alias("path_null"),
        F.col("path").alias("path"),
        F.coalesce(F.col("in_transit_weeks_of_stock"), F.lit(0.0)).alias("it"),
    )
    return (
        j.groupBy(
            "top_level_bom",
            text_key(F.col("top_level_revision")).alias("top_level_revision"),
            text_key(F.col("system")).alias("system_group"),
        )
        .agg(F.min(ranked).alias("_pick"))
        .select(
            "top_level_bom",
            "top_level_revision",
            "system_group",
            F.col("_pick.it").cast("double").alias("system_min_in_transit_weeks"),
        )
    )
