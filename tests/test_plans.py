"""Physical-plan properties of the registered queries."""

import pytest

import __spark_entry__ as entry
from conftest import SF0001

from kitwise.plans import extras
from kitwise.plans.catalog import all_queries

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
)
# the training-data queries have their own tests, in tests/llm
CHECKED = sorted({**all_queries(), **extras.queries()})


def plan(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", CHECKED)
def test_no_nested_loop_cartesian_or_python(spark, name):
    p = plan(spark, entry.queries()[name](spark, SF0001))
    assert [f for f in FORBIDDEN if f in p] == []


def test_movement_filters_reach_the_scan(spark):
    p = plan(spark, entry.queries()["move_category"](spark, SF0001))
    assert "EqualTo(state,done)" in p and "GreaterThanOrEqual(date," in p


def test_top1_ranks_limit_before_the_shuffle(spark):
    p = plan(spark, entry.queries()["latest_po"](spark, SF0001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_no_path_text_is_moved_in_the_ancestor_join(spark):
    """Exchanges of the join have row numbers; the lines' paths come back by number, once a line."""
    df = entry.queries()["ancestor_usage"](spark, SF0001)
    p = df._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in p.splitlines() if "Join" in line]
    assert len(joins) >= 2 and not any("bytes" in j or "path_without_revision" in j for j in joins)
    assert "pipe" not in p and "startswith" not in p.lower()


def test_a_query_reads_only_the_inputs_of_its_stage(spark):
    p = plan(spark, entry.queries()["inventory_alt"](spark, SF0001))
    assert "/inventory" in p and not any(f"/{other}" in p for other in ("stock_move", "supply_plans", "shipments"))

