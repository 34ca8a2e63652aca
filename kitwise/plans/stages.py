"""The report's stage graph, built lazily from its inputs.

Every attribute is one stage's DataFrame (a logical plan; nothing runs until
an action). Stages read by several others (``HOT_STAGES``) can be
materialized once on first use, which keeps every later plan small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from kitwise.operators import (
    alternate_sums,
    alternates,
    coverage,
    cost,
    demand,
    enrichment,
    hierarchy,
    inventory,
    movements,
    parents,
    report,
    supply_plan,
    transit,
)
from kitwise.params import ReportParams
from kitwise.plans.scratch import Folder
from kitwise.sources.tables import ReportInputs

# Stages read by several others in a full report run; all but the first four
# are aggregates, far smaller than the inputs.
HOT_STAGES = (
    "lines",
    "spine",
    "moves",
    "groups",
    "report_parts",
    "alternate_classes",
    "class_links",
    "root_demand_by_type",
    "po_line_latest",
    "part_cost",
    "ancestor_usage",
    "inventory_by_part",
    "in_transit",
    "part_net_demand",
    "alternate_sums",
    "shared_paths",
)

# Demand per root and week: small beside the lines that meet it, which only a
# written table's size can show to the planner. Written whatever the mode.
ROOT_STAGES = ("root_weekly_by_type", "root_weekly_demand")


class ReportStages:
    """Lazily built stages.

    ``materialize`` decides what happens to a stage of ``HOT_STAGES`` the
    first time it is used: ``None`` leaves it as a plan, ``"table"`` writes it
    as Parquet under the session's checkpoint directory and reads it back
    (cuts the lineage, keeps columnar pruning, survives executor loss),
    ``"persist"`` keeps it in the block store. Stages of ``ROOT_STAGES`` are
    always written. ``hot`` may name fewer stages of ``HOT_STAGES``.
    """

    def __init__(
        self, inputs: ReportInputs, params: ReportParams, materialize: str | None = None, hot: Sequence[str] = HOT_STAGES
    ):
        self.i = inputs
        self.p = params
        self.materialize = materialize
        self.hot = frozenset(hot if materialize else ())
        self._persisted: list[DataFrame] = []
        self._folder: Folder | None = None

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        if (name in HOT_STAGES or name in ROOT_STAGES) and isinstance(value, DataFrame):
            d = object.__getattribute__(self, "__dict__")
            done = d.setdefault("_materialized", set())
            if name not in done and (name in ROOT_STAGES or name in object.__getattribute__(self, "hot")):
                done.add(name)
                value = object.__getattribute__(self, "_materialize")(name, value)
                d[name] = value
        return value

    def _materialize(self, name: str, df: DataFrame) -> DataFrame:
        if self.materialize == "persist" and name not in ROOT_STAGES:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(df)
            return df
        if self._folder is None:
            self._folder = Folder(df.sparkSession, "kitwise-stages")
        return self._folder.write(df, name)

    # A. Hierarchy ---------------------------------------------------------
    @cached_property
    def eligible_roots(self) -> DataFrame:
        return hierarchy.eligible_roots(self.i.demand, self.p)

    @cached_property
    def child_parts(self) -> DataFrame:
        return hierarchy.child_parts(self.i.bom)

    @cached_property
    def demanded_roots(self) -> DataFrame:
        return hierarchy.demanded_roots(self.eligible_roots, self.child_parts)

    @cached_property
    def lines(self) -> DataFrame:
        return hierarchy.scoped_lines(self.i.bom, self.eligible_roots, self.p)

    @cached_property
    def part_root_rollup(self) -> DataFrame:
        return hierarchy.part_root_rollup(self.lines, self.demanded_roots, self.p)

    @cached_property
    def part_rollup(self) -> DataFrame:
        return hierarchy.part_rollup(self.part_root_rollup)

    @cached_property
    def assembly_root_rollup(self) -> DataFrame:
        return hierarchy.assembly_root_rollup(self.lines, self.demanded_roots, self.child_parts)

    @cached_property
    def ancestor_usage(self) -> DataFrame:
        return hierarchy.ancestor_usage(self.lines, self.child_parts)

    # B. Demand ------------------------------------------------------------
    @cached_property
    def demand_rows(self) -> DataFrame:
        return demand.demand_rows(self.i.demand)

    @cached_property
    def root_demand_by_type(self) -> DataFrame:
        return demand.root_demand_by_type(self.demand_rows, self.p)

    @cached_property
    def line_gross_demand(self) -> DataFrame:
        return demand.line_gross_demand(self.lines, self.root_demand_by_type)

    @cached_property
    def part_gross_demand_by_type(self) -> DataFrame:
        return demand.part_gross_demand_by_type(self.lines, self.root_demand_by_type)

    @cached_property
    def part_gross_demand_this_week(self) -> DataFrame:
        return demand.part_gross_demand_this_week(self.part_gross_demand_by_type)

    @cached_property
    def weekly_gross_demand(self) -> DataFrame:
        return demand.weekly_gross_demand(self.lines, self.root_weekly_by_type)

    @cached_property
    def root_weekly_by_type(self) -> DataFrame:
        return demand.root_weekly_by_type(self.demand_rows, self.p)

    @cached_property
    def root_weekly_demand(self) -> DataFrame:
        return demand.root_weekly_demand(self.demand_rows, self.p)

    @cached_property
    def weekly_remaining_demand(self) -> DataFrame:
        return demand.weekly_remaining_demand(
            self.lines, self.root_weekly_demand, self.consumption_this_week, self.p
        )

    @cached_property
    def last_demand_week(self) -> DataFrame:
        return demand.last_demand_week(self.lines, self.root_weekly_demand)

    @cached_property
    def part_net_demand(self) -> DataFrame:
        return demand.part_net_demand(
            self.part_gross_demand_by_type, self.part_gross_demand_this_week, self.consumption_this_week
        )

    @cached_property
    def part_net_demand_this_week(self) -> DataFrame:
        return demand.part_net_demand_this_week(self.part_net_demand)

    # C. Enrichment --------------------------------------------------------
    @cached_property
    def with_structure(self) -> DataFrame:
        return enrichment.with_structure(self.lines, self.i.structured)

    @cached_property
    def spine(self) -> DataFrame:
        return enrichment.with_commodity(self.with_structure, self.i.flat_parts)

    @cached_property
    def report_parts(self) -> DataFrame:
        return enrichment.report_parts(self.spine)

    # D. Alternates --------------------------------------------------------
    @cached_property
    def groups(self) -> DataFrame:
        c = self.p.columns
        return alternates.alternate_groups(self.i.alternates, c.alternates_text)

    @cached_property
    def directed_bridge(self) -> DataFrame:
        return alternates.directed_bridge(self.groups)

    @cached_property
    def alternate_bridge(self) -> DataFrame:
        return alternates.alternate_bridge(self.report_parts, self.groups)

    @cached_property
    def alternates_text(self) -> DataFrame:
        return alternates.alternates_text(self.report_parts, self.groups)

    @cached_property
    def alternate_classes(self) -> DataFrame:
        return alternates.alternate_classes(self.groups)

    @cached_property
    def class_links(self) -> DataFrame:
        return alternates.class_links(self.groups, self.alternate_classes)

    @cached_property
    def part_figures(self) -> DataFrame:
        return alternate_sums.part_figures(
            self.inventory_by_part,
            movements.receipt_window_sums(self.receipts, self.p),
            self.supply_this_week,
            supply_plan.plan_sums(self.supply_plan_rows, self.p),
        )

    @cached_property
    def alternate_sums(self) -> DataFrame:
        return alternate_sums.alternate_sums(self.report_parts, self.groups, self.part_figures, self.alternate_classes, self.class_links)

    def _over_alternates(self, figures: DataFrame, columns: list[str]) -> DataFrame:
        """One source's figures summed over alternates; a report run sums all sources in one pass instead."""
        if "alternate_sums" in self.hot:
            return self.alternate_sums
        return alternates.sum_over_alternates(
            self.report_parts, self.groups, figures, columns, classes=self.alternate_classes, links=self.class_links
        )

    # E. Cost --------------------------------------------------------------
    @cached_property
    def po_line_versions(self) -> DataFrame:
        return self._po_line_versions()

    def _po_line_versions(self, newest_only: bool = False) -> DataFrame:
        i = self.i
        return cost.po_line_versions(
            i.po_line, i.po_version, i.purchase_order, i.product_template, i.po_supplier, i.uom, i.uom_factor, newest_only
        )

    @cached_property
    def po_line_latest(self) -> DataFrame:
        return cost.po_line_latest(self.po_line_versions)

    @cached_property
    def latest_po(self) -> DataFrame:
        return cost.latest_po(self.po_line_latest)

    @cached_property
    def latest_part_cost(self) -> DataFrame:
        # a written E2 serves E3 too; for the cost alone only lines that may be their part's newest are worked out
        lines = self.po_line_latest if "po_line_latest" in self.hot else cost.po_line_latest(self._po_line_versions(newest_only=True))
        return cost.latest_part_cost(lines)

    @cached_property
    def forecast_cost(self) -> DataFrame:
        return cost.forecast_cost(self.i.forecast, self.p)

    @cached_property
    def part_cost(self) -> DataFrame:
        return cost.part_cost(self.latest_part_cost, self.forecast_cost, self.p)

    # F. Movements ---------------------------------------------------------
    @cached_property
    def location_category(self) -> DataFrame:
        return movements.location_category(self.i.stock_location, self.p)

    @cached_property
    def moves(self) -> DataFrame:
        i = self.i
        return movements.classify_moves(
            i.stock_move, i.product_product, i.product_template, self.location_category, self.p
        )

    @cached_property
    def receipts(self) -> DataFrame:
        return movements.receipts(self.moves)

    @cached_property
    def supply_this_week(self) -> DataFrame:
        return movements.supply_this_week(self.receipts, self.p)

    @cached_property
    def consumption_this_week(self) -> DataFrame:
        return movements.consumption_this_week(self.moves, self.p)

    @cached_property
    def receipt_rates(self) -> DataFrame:
        return movements.receipt_rates(self.receipts, self.p)

    @cached_property
    def latest_receipt_alt(self) -> DataFrame:
        return movements.latest_receipt_alt(self.report_parts, self.groups, self.receipts, self.p)

    @cached_property
    def receipt_rates_alt(self) -> DataFrame:
        figures = movements.receipt_window_sums(self.receipts, self.p)
        sums = self._over_alternates(figures, ["received_4w", "received_8w"])
        return movements.receipt_rates_alt(self.report_parts, sums, self.latest_receipt_alt, self.p)

    @cached_property
    def supply_this_week_alt(self) -> DataFrame:
        return movements.supply_this_week_alt(self._over_alternates(self.supply_this_week, ["current_week_supply"]))

    # G. Inventory ---------------------------------------------------------
    @cached_property
    def inventory_by_part(self) -> DataFrame:
        return inventory.inventory_by_part(self.i.inventory, self.location_category, self.part_cost, self.p)

    @cached_property
    def inventory_alt(self) -> DataFrame:
        columns = list(inventory.INVENTORY_METRICS)
        figures = self.inventory_by_part.fillna(0.0, columns)
        return inventory.inventory_alt(self._over_alternates(figures, columns))

    # H. In transit --------------------------------------------------------
    @cached_property
    def latest_shipments(self) -> DataFrame:
        return transit.latest_shipments(self.i.shipments, self.p)

    @cached_property
    def shipment_lines(self) -> DataFrame:
        return transit.shipment_lines(self.i.shipment_lines, self.latest_shipments, self.p)

    @cached_property
    def in_transit(self) -> DataFrame:
        return transit.in_transit(self.shipment_lines, self.p)

    @cached_property
    def in_transit_alt(self) -> DataFrame:
        return transit.in_transit_alt(self.report_parts, self.in_transit, self.directed_bridge)

    # I. Parents -----------------------------------------------------------
    @cached_property
    def parent_alternate_candidates(self) -> DataFrame:
        return parents.parent_alternate_candidates(self.ancestor_usage, self.groups)

    @cached_property
    def alt_parent_latest_rev(self) -> DataFrame:
        return parents.alt_parent_latest_rev(self.ancestor_usage, self.groups, self.i.bom)

    @cached_property
    def alt_parent_requirements(self) -> DataFrame:
        return parents.alt_parent_requirements(self.alt_parent_latest_rev, self.i.bom, self.p)

    @cached_property
    def alt_component_supply(self) -> DataFrame:
        return parents.alt_component_supply(
            self.alt_parent_requirements,
            self.groups,
            self.inventory_by_part,
            self.in_transit,
            self.part_net_demand_this_week,
        )

    @cached_property
    def buildable_sets(self) -> DataFrame:
        return parents.buildable_sets(self.alt_parent_requirements, self.alt_component_supply)

    @cached_property
    def line_parent_alternates(self) -> DataFrame:
        return parents.line_parent_alternates(
            self.parent_alternate_candidates, self.inventory_by_part, self.in_transit, self.buildable_sets
        )

    @cached_property
    def line_parent_stock(self) -> DataFrame:
        return parents.line_parent_stock(self.ancestor_usage, self.inventory_by_part, self.assembly_root_rollup)

    # J. Weeks of stock ----------------------------------------------------
    @cached_property
    def demand_horizon(self) -> DataFrame:
        return coverage.demand_horizon(self.spine, self.last_demand_week, self.p)

    @cached_property
    def shared_paths(self) -> DataFrame:
        return coverage.shared_paths(self.spine)

    @cached_property
    def weekly_demand_map(self) -> DataFrame:
        return coverage.weekly_demand_map(self.weekly_remaining_demand, self.p)

    @cached_property
    def line_weeks(self) -> DataFrame:
        return coverage.line_weeks(
            self.demand_horizon,
            self.shared_paths,
            self.weekly_demand_map,
            self.inventory_alt,
            self.line_parent_stock,
            self.in_transit_alt,
        )

    @cached_property
    def weekly_coverage(self) -> DataFrame:
        return coverage.weekly_coverage(self.line_weeks, self.p)

    @cached_property
    def weeks_of_stock(self) -> DataFrame:
        return coverage.weeks_of_stock(self.line_weeks)

    @cached_property
    def system_alternate_lines(self) -> DataFrame:
        return coverage.system_alternate_lines(self.spine, self.directed_bridge)

    @cached_property
    def system_min_weeks(self) -> DataFrame:
        return coverage.system_min_weeks(self.spine, self.weeks_of_stock, self.system_alternate_lines, self.p)

    # K. Supply plan -------------------------------------------------------
    @cached_property
    def supply_plan_rows(self) -> DataFrame:
        return supply_plan.supply_plan_rows(self.i.supply_plans, self.p)

    @cached_property
    def supply_plan(self) -> DataFrame:
        return supply_plan.supply_plan(self.supply_plan_rows, self.supply_this_week, self.p)

    @cached_property
    def supply_plan_alt(self) -> DataFrame:
        if "alternate_sums" in self.hot:
            return supply_plan.supply_plan_alt(self.alternate_sums)
        plans = self._over_alternates(supply_plan.plan_sums(self.supply_plan_rows, self.p), ["_plan4", "_plan8"])
        supply = self._over_alternates(self.supply_this_week, ["current_week_supply"])
        return supply_plan.supply_plan_alt(plans.join(supply, "part_number"))

    # L. Report ------------------------------------------------------------
    @cached_property
    def part_metrics(self) -> DataFrame:
        return report.part_metrics(
            self.report_parts,
            self.part_rollup,
            self.alternates_text,
            self.part_cost,
            self.receipt_rates,
            self.receipt_rates_alt,
            self.inventory_by_part,
            self.in_transit_alt,
            self.inventory_alt,
            self.supply_plan,
            self.supply_plan_alt,
        )

    @cached_property
    def report_raw(self) -> DataFrame:
        return report.assemble(
            self.spine,
            self.part_metrics,
            self.line_gross_demand,
            self.line_parent_stock,
            self.line_parent_alternates,
            self.weeks_of_stock,
            self.latest_po,
            self.part_net_demand,
            self.system_min_weeks,
        )

    @cached_property
    def report_final(self) -> DataFrame:
        return report.publish(self.report_raw)

    # ----------------------------------------------------------------------
    def release(self) -> None:
        """Drop persisted blocks and delete the stage tables this graph wrote."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        if self._folder is not None:
            self._folder.delete()
            self._folder = None
