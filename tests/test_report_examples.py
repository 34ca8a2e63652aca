"""Worked examples of the report, on hand-made inputs (own part names and numbers)."""

import helpers as h

from kitwise.operators.hierarchy import rollup_of_rows
from kitwise.operators.report import PUBLISHED_COLUMNS, publish
from kitwise.plans.stages import ReportStages


def stages(spark, empty_inputs, **rows):
    return ReportStages(h.make_inputs(spark, empty_inputs, **rows), h.PARAMS)


def rows_of(df, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in df.collect()}


def test_rollup_is_the_largest_over_demanded_roots(spark, empty_inputs):
    bom = [
        h.bom_row("|CART|", "CART", "CART", 1, indent=0),
        h.bom_row("|CART|WHEEL|", "WHEEL", "CART", 4),
        h.bom_row("|CART|AXLE|WHEEL|", "WHEEL", "CART", 2, indent=2, parent="AXLE"),
        h.bom_row("|SLED|", "SLED", "SLED", 1, indent=0),
        h.bom_row("|SLED|WHEEL|", "WHEEL", "SLED", 3),
        h.bom_row("|IDLE|WHEEL|", "WHEEL", "IDLE", 50),
    ]
    st = stages(spark, empty_inputs, bom=bom, demand=h.demand_rows([("CART", "R1"), ("SLED", "R1")]))
    per_root = st.part_root_rollup.where("part_number = 'WHEEL'")
    assert rows_of(per_root, "top_level_bom", "total_rolled_up_quantity") == {"CART": (6.0,), "SLED": (3.0,)}
    assert rows_of(st.part_rollup, "part_number", "total_rolled_up_quantity")["WHEEL"] == (6.0,)


def test_stock_in_parents_counts_each_ancestor(spark, empty_inputs):
    # a bolt stands 6 to a frame of which 15 are held, and 4 to a gate of which 5 are held: 90 + 20
    bom = [
        h.bom_row("|CART|", "CART", "CART", 1, indent=0),
        h.bom_row("|CART|GATE|", "GATE", "CART", 3, intent="make"),
        h.bom_row("|CART|GATE|FRAME|", "FRAME", "CART", 2, intent="make", indent=2, parent="GATE"),
        h.bom_row("|CART|GATE|FRAME|BOLT|", "BOLT", "CART", 12, indent=3, parent="FRAME"),
    ]
    st = stages(
        spark, empty_inputs, bom=bom, demand=h.demand_rows([("CART", "R1")]),
        inventory=h.inventory_rows({"FRAME": 15, "GATE": 5}), stock_location=h.locations(),
    )
    got = rows_of(st.line_parent_stock, "path", "on_hand_in_parents", "sets_in_parents")
    assert got["|CART|GATE|FRAME|BOLT|"] == (110.0, 15 / 2 + 5 / 3)


def test_sets_of_alternate_parents_stop_at_the_scarcest_component(spark, empty_inputs):
    bom = [
        h.bom_row("|CART|", "CART", "CART", 1, indent=0),
        h.bom_row("|CART|GATE|", "GATE", "CART", 1, intent="make"),
        h.bom_row("|CART|GATE|BOLT|", "BOLT", "CART", 2, indent=2, parent="GATE"),
        # the gate's alternate has its own bill: 2 hinges and 5 nuts
        h.bom_row("|DOOR|", "DOOR", "DOOR", 1, indent=0, root_rev="R2"),
        h.bom_row("|DOOR|HINGE|", "HINGE", "DOOR", 2, root_rev="R2"),
        h.bom_row("|DOOR|NUT|", "NUT", "DOOR", 5, root_rev="R2"),
    ]
    st = stages(
        spark, empty_inputs, bom=bom, demand=h.demand_rows([("CART", "R1")]), alternates=[(1, "GATE, DOOR")],
        inventory=h.inventory_rows({"HINGE": 6, "NUT": 40}), stock_location=h.locations(),
    )
    assert rows_of(st.buildable_sets, "alternate_parent_part_number", "sets_on_hand")["DOOR"] == (3.0,)
    got = rows_of(st.line_parent_alternates, "path", "sets_of_alt_parents")
    assert got["|CART|GATE|BOLT|"] == (3.0,)


def test_rows_as_their_own_hierarchy(spark):
    fields = "path string, part_number string, parent_bom string, indent_level int, top_level_bom string, top_level_revision string"
    fields += ", adjusted_quantity string, adjusted_procurement_intent string"
    rows = [
        ("a", "WHEEL", "CART", 1, "CART", "R1", "4", "buy"),
        ("b", "WHEEL", "AXLE", 2, "CART", "R1", "2", "buy"),
        ("c", "WHEEL", "SLED", 1, "SLED", None, "5", "buy"),
        ("d", "WHEEL", "SLED", 1, "SLED", "", "2", "buy"),  # NULL and '' are one revision: 7
        ("e", "WHEEL", "SLED", 1, "SLED", "", "100", "make"),
        ("f", "DOOR", "SHED", 1, "SHED", "R1", "1", "make"),
        ("g", "HINGE", "DOOR", 1, "DOOR", "R1", "9", "buy"),  # a root that is a child counts for nothing
        ("h", "HINGE", "SHED", 2, "SHED", "R1", "3", "buy"),
        ("i", "KNOB", "SHED", 1, "SHED", "R1", "n/a", "buy"),
    ]
    df = spark.createDataFrame(rows, fields)
    got = rows_of(rollup_of_rows(df, h.PARAMS), "path", "total_rolled_up_quantity")
    assert got == {**{x: (7.0,) for x in "abcde"}, "f": (None,), "g": (3.0,), "h": (3.0,), "i": (0.0,)}
    given = spark.createDataFrame([("a", "2.5"), ("b", "junk")], "path string, total_rolled_up_quantity string")
    assert rows_of(rollup_of_rows(given, h.PARAMS), "path", "total_rolled_up_quantity") == {"a": (2.5,), "b": (None,)}
    assert rollup_of_rows(df.limit(0), h.PARAMS).count() == 0


def test_publish_fills_missing_columns(spark):
    raw = spark.createDataFrame([("|PUMP|", "P1", 7.5)], "path string, part_number string, net_current_week double")
    out = publish(raw)
    assert out.columns == [c[0] for c in PUBLISHED_COLUMNS]
    row = out.first()
    assert row["Current Week Net Demand"] == 7.5 and row["Current Week Net Total Demand"] == 7.5
    assert row["Weeks of Stock"] == 0.0 and row["Unit Cost Used"] is None


def test_text_that_is_no_number_is_published_as_zero(spark):
    row = publish(spark.createDataFrame([("n/a", "4.5")], "weeks_of_stock string, net_current_week string")).first()
    assert row["Weeks of Stock"] == 0.0 and row["Current Week Net Demand"] == 4.5
