"""Weekly demand of parts: no row of a week is shuffled, whatever the number of roots of a part."""

import datetime as dt
import re

from kitwise.operators import coverage, demand
from kitwise.sources.standins import PARAMS

W0 = PARAMS.week0


def week(n):
    return W0 + dt.timedelta(days=7 * n)


def lines(spark):
    rows = [
        ("P1", "A", "R1", "1", 2.0),  # one root, two lines
        ("P1", "A", "R1", "1", 1.0),
        ("P2", "A", "R1", "1", 1.0),  # two roots
        ("P2", "A", "R2", None, 5.0),
        ("P3", None, "R2", "", 4.0),  # the same part with both spellings of no revision
        ("P3", "", "R1", "1", None),
        (None, "A", "R1", "1", 1.0),
        ("P4", "A", "R3", "1", 1.0),  # a root without demand
    ]
    names = "part_number string, revision string, top_level_bom string, top_level_revision string, adjusted_quantity double"
    return spark.createDataFrame(rows, names)


def demands(spark):
    rows = [
        ("R1", "1", 3.0, "Production", week(0)),
        ("R1", "1", 2.0, "Production", week(0)),
        ("R1", "1", 7.0, "Spares", week(0)),
        ("R1", "1", 1.0, None, week(2)),
        ("R2", "", 2.0, "Production", week(0)),
        ("R2", None, 1.0, "Spares", week(1)),
        ("R2", "", 9.0, "Spares", week(-1)),
    ]
    names = "top_level_bom string, top_level_revision string, demand_quantity double, demand_type string, demand_week date"
    return spark.createDataFrame(rows, names)


def moved_weeks(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "week" in x]


def test_gross_demand(spark, tmp_path):
    demand.root_weekly_by_type(demands(spark), PARAMS).write.parquet(f"{tmp_path}/roots")
    got = demand.weekly_gross_demand(lines(spark), spark.read.parquet(f"{tmp_path}/roots"))
    expect = [
        ("P1", "A", week(0), "Production", 15.0), ("P1", "A", week(0), "Spares", 21.0), ("P1", "A", week(2), None, 3.0),
        ("P2", "A", week(0), "Production", 15.0), ("P2", "A", week(0), "Spares", 7.0), ("P2", "A", week(1), "Spares", 5.0),
        ("P2", "A", week(2), None, 1.0),
        ("P3", "", week(0), "Production", 0.0), ("P3", "", week(0), "Spares", 0.0), ("P3", "", week(2), None, 0.0),
        ("P3", None, week(0), "Production", 8.0), ("P3", None, week(1), "Spares", 4.0),
        (None, "A", week(0), "Production", 5.0), (None, "A", week(0), "Spares", 7.0), (None, "A", week(2), None, 1.0),
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expect, key=str)
    assert moved_weeks(got) == []


def test_remaining_demand(spark, tmp_path):
    demand.root_weekly_demand(demands(spark), PARAMS).write.parquet(f"{tmp_path}/roots")
    used = spark.createDataFrame(
        [("P1", 10.0, 4.0), ("P2", 3.0, 100.0)], "part_number string, production_consumption double, nest_consumption double"
    )
    got = demand.weekly_remaining_demand(lines(spark), spark.read.parquet(f"{tmp_path}/roots"), used, PARAMS)
    expect = [
        ("P1", "A", week(0), 22.0), ("P1", "A", week(2), 3.0),
        ("P2", "A", week(0), 0.0), ("P2", "A", week(1), 5.0), ("P2", "A", week(2), 1.0),
        ("P3", "", week(0), 0.0), ("P3", "", week(2), 0.0), ("P3", None, week(0), 8.0), ("P3", None, week(1), 4.0),
        (None, "A", week(0), 12.0), (None, "A", week(2), 1.0),
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expect, key=str)
    assert moved_weeks(got) == []


def shuffled_columns(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    return " ".join(re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan))


def test_weeks_of_lines_are_made_where_the_parts_are(spark, tmp_path):
    demand.root_weekly_demand(demands(spark), PARAMS).write.parquet(f"{tmp_path}/roots")
    roots = spark.read.parquet(f"{tmp_path}/roots")
    used = spark.createDataFrame([], "part_number string, production_consumption double, nest_consumption double")
    remaining = demand.weekly_remaining_demand(lines(spark), roots, used, PARAMS)
    horizon = spark.createDataFrame(
        [("|R1|P1|", "P1", "A", 2), ("|R2|P3|", "P3", None, 1), ("|R3|P4|", "P4", "A", 0)],
        "path string, part_number string, revision string, max_week_offset int",
    ).repartition("path")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = coverage.weeks_of_stock(
            coverage.line_weeks(
                horizon,
                coverage.shared_paths(horizon),
                coverage.weekly_demand_map(remaining, PARAMS),
                spark.createDataFrame([("P1", 36.5)], "part_number string, on_hand_alt double"),
                spark.createDataFrame([("|R2|P3|", 9.0)], "path string, on_hand_in_parents double"),
                spark.createDataFrame([("P3", 2.0)], "part_number string, in_transit_alt double"),
            )
        )
        moved = shuffled_columns(spark, got)
        rows = sorted(map(tuple, got.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # P1 has 36 in week 0 and 3 in week 2; P3 has 8 and 0 (of both spellings) in week 0, 4 in week 1
    assert rows == [
        ("|R1|P1|", "P1", "A", 2 + 0.5 / 3, 2 + 0.5 / 3, 0.0),
        ("|R2|P3|", "P3", None, 2.25, 2.75, 0.25),
        ("|R3|P4|", "P4", "A", 1.0, 1.0, 0.0),
    ]
    assert "path" in moved


def test_components_collect_no_links_for_broadcasts(spark, monkeypatch):
    from kitwise.operators import components

    plans = []
    write = components.Folder.write

    def written(self, df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, df, name)

    monkeypatch.setattr(components.Folder, "write", written)
    rows = spark.createDataFrame([(f"P{i:02}", f"P{i + 1:02}") for i in range(9)] + [("X", None)], "part_number string, alternates_text string")
    found = components.alternate_components(rows, ("alternates_text",))
    plans.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    assert {(r[1], r[2]) for r in found.collect()} == {("P00", 10), ("X", 1)}
    assert len(plans) > 3 and [name for name, plan in plans if "Broadcast" in plan] == []
