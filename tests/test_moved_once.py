"""Rows of lines and moves meet their lookups with as few shuffles as their keys need, and give the same results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import PARAMS, bom_row, demand_rows, inventory_rows, locations, make_inputs
from kitwise.operators import cost, movements
from kitwise.operators.components import direct_parent_on_hand
from kitwise.plans.stages import ReportStages


@pytest.fixture(scope="module")
def purchases(spark):
    """Lines with ties, repeated and null keys, negative factors and templates that share a part."""
    rnd = random.Random(7)
    some = lambda *values: rnd.choice(values)
    days = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    lines = [
        (some(1, 2, 3, None), some(1, 2, None), some(1, 2, 3, 4, None), some(1, 2, 3, 4, None), some(1, 2, None),
         some(1, 5, 9, None), some(*days, None), "C")
        for _ in range(400)
    ]
    frame = spark.createDataFrame
    return (
        frame(lines, "id long, line_number int, purchase_order_version_id long, part_template_id long, unit_of_measure_id long, "
              "unit_price_ucents long, created_at timestamp_ntz, major_revision_name string"),
        frame([(1, 1, 1, "ISSUED"), (2, 2, 2, "ISSUED"), (3, None, None, "ISSUED"), (4, 1, 1, "DRAFT"), (1, 2, 1, "ISSUED")],
              "id long, purchase_order_id long, supplier_id long, status string"),
        frame([(1, "PO1"), (2, "PO2"), (2, None)], "id long, purchase_order_number string"),
        frame([(1, "P1"), (2, "P1"), (3, "P2"), (3, "P3"), (4, None)], "id long, default_code string"),
        frame([(1, "S1"), (1, "S2")], "id long, name string"),
        frame([(1, 1), (2, 2), (2, 1)], "id long, unit_ref_id long"),
        frame([(1, 2.0), (2, -1.0)], "id long, factor double"),
    )


def test_newest_lines_alone_give_the_same_part_cost(purchases):
    of = lambda only: cost.latest_part_cost(cost.po_line_latest(cost.po_line_versions(*purchases, newest_only=only)))
    whole = sorted(map(tuple, of(False).collect()))
    assert sorted(map(tuple, of(True).collect())) == whole and len(whole) == 3


def test_versions_are_those_of_joins_line_by_line(purchases):
    pol, pov, po, pt, sup, zu, uf = (df.alias(n) for df, n in zip(purchases, "pol pov po pt sup zu uf".split(), strict=True))
    j = (
        pol.join(pov.where("status = 'ISSUED'"), F.expr("pol.purchase_order_version_id = pov.id"))
        .join(po, F.expr("pov.purchase_order_id = po.id"), "left")
        .join(pt.where("default_code IS NOT NULL"), F.expr("pol.part_template_id = pt.id"))
        .join(sup, F.expr("sup.id = pov.supplier_id"), "left")
        .join(zu, F.expr("pol.unit_of_measure_id = zu.id"), "left")
        .join(uf, F.expr("zu.unit_ref_id = uf.id"), "left")
    )
    want = j.selectExpr("pol.id", "purchase_order_number", "pol.line_number", "pol.created_at", "default_code", "sup.name", "factor")
    got = cost.po_line_versions(*purchases).select(
        "id", "purchase_order_number", "line_number", "po_created_at", "part_number", "supplier_name", "uom_factor"
    )
    assert sorted(map(str, got.collect())) == sorted(map(lambda r: str(r), want.toDF(*got.columns).collect()))


def test_newest_lines_are_picked_before_the_lookups(spark, purchases):
    plan = cost.po_line_versions(*purchases, newest_only=True)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("rank(", 1)
    assert "default_code" in above and above.count("Join") == 2 and below.count("Join") >= 1


def test_moves_are_dealt_once_by_product(spark, empty_inputs):
    i = make_inputs(spark, empty_inputs, stock_location=locations())
    moves = movements.classify_moves(
        i.stock_move, i.product_product, i.product_template, movements.location_category(i.stock_location, PARAMS), PARAMS
    )
    joins = [x for x in moves._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in x]
    assert "product_id" in joins[0]  # last of all, with products that have their templates


def test_direct_parent_writes_only_what_it_reads_often(spark, empty_inputs):
    bom = [bom_row("|R|R1|", "R", "R", 1, intent="make", indent=0), bom_row("|R|R1|A|A|", "A", "R", 2), bom_row("|R|R1|A|A|B|A|", "B", "R", 3, parent="A")]
    i = make_inputs(spark, empty_inputs, bom=bom, demand=demand_rows([("R", "R1")]), inventory=inventory_rows({"A": 5}), stock_location=locations())
    found = []
    for hot in ({}, {"hot": ("spine", "inventory_by_part")}):
        st = ReportStages(i, PARAMS, "table", **hot)
        rows = st.spine.join(st.inventory_by_part.select("part_number", "on_hand"), "part_number", "left")
        found.append(sorted(map(tuple, direct_parent_on_hand(rows).collect())))
        written = st._materialized
        st.release()
    assert found[0] == found[1] and ("|R|R1|A|A|B|A|", "B", 15.0) in found[1]
    assert written == {"spine", "inventory_by_part"}
