import datetime as dt

from pyspark.sql import functions as F

from kitwise.functions import (
    coverage,
    movement_category,
    movement_quantity,
    normalize_status,
    not_text_true,
    plain_path,
    plain_path_inline,
    split_part_list,
    week_start,
)


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col(F.col("x")).alias("y")).first()["y"]


def test_plain_path_drops_revision_segments(spark):
    assert one(spark, plain_path, "|PUMP|A1|ROTOR-9|B|") == "|PUMP|ROTOR-9|"
    # Non-overlapping: the pipe eaten by |A| is not available to |B|.
    assert one(spark, plain_path, "|MOTOR7|A|B|") == "|MOTOR7|B|"


def test_plain_path_inline_form(spark):
    assert one(spark, plain_path_inline, "PUMP:REV2|ROTOR:REVB") == "PUMP|ROTOR"
    assert one(spark, plain_path_inline, "||PUMP:REV2|||ROTOR:REV3|") == "PUMP|ROTOR"
    assert one(spark, plain_path_inline, "|PUMP|A1|ROTOR-9|B|") == "|PUMP|ROTOR-9|"
    assert one(spark, plain_path_inline, "") == ""
    assert one(spark, plain_path_inline, None) is None


def test_status_normalizer(spark):
    assert one(spark, normalize_status, " Delivered / completed ") == "DELIVERED_COMPLETED"
    assert one(spark, normalize_status, None) == ""
    assert one(spark, normalize_status, "done!") == "DONE_"


def test_text_booleans(spark):
    vals = ["yes", "T", "1", "false", "on", None, "junk"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    rows = df.select(not_text_true(F.col("x")).alias("n")).collect()
    assert [r["n"] for r in rows] == [False, False, False, True, False, True, True]


def test_split_part_list(spark):
    assert sorted(one(spark, split_part_list, " A, ,B,A,, C ")) == ["A", "B", "C"]


def test_week_start_is_monday(spark):
    assert one(spark, week_start, dt.date(2026, 3, 15), "date") == dt.date(2026, 3, 9)


def _cov_sum(spark, stock, demands):
    rows, prior = [], 0.0
    for d in demands:
        rows.append((float(stock), prior, float(d)))
        prior += d
    df = spark.createDataFrame(rows, "s double, p double, d double")
    return df.select(F.sum(coverage(F.col("s"), F.col("p"), F.col("d")))).first()[0]


def test_coverage_rule(spark):
    assert _cov_sum(spark, 10, [4, 0, 8, 1]) == 2.75
    assert _cov_sum(spark, 0, [0]) == 1.0
    assert _cov_sum(spark, 0, [0, 5]) == 1.0


# Every rule, with either kind of stock location, and pairs that no rule names.
STOCKS = ("Warehouse", "Receiving & Pre-IQC")
INTO = {
    "Vendors": ("New Supply", 1), "Nest": ("RMA Supply", 1), "Production": ("Production Consumption", -1),
    "Scrap": ("QC Loss Consumption", -1), "Quarantine": ("QC Loss Consumption", -1), "R&D": ("R&D Supply", 1),
}
OUT_OF = {
    "Vendors": ("New Supply", -1), "Nest": ("Nest Consumption", 1), "Production": ("Production Consumption", 1),
    "Scrap": ("QC Loss Consumption", 1), "Quarantine": ("QC Loss Consumption", 1), "R&D": ("R&D Consumption", 1),
}
MOVES = [
    *[(place, s, 4.0, name, 4.0 * sign) for place, (name, sign) in INTO.items() for s in STOCKS],
    *[(s, place, 4.0, name, 4.0 * sign) for place, (name, sign) in OUT_OF.items() for s in STOCKS],
    ("Warehouse", "Receiving & Pre-IQC", 2.0, "Unknown", None),
    ("Nest", "Scrap", 2.0, "Unknown", None),
    ("Unknown", "Warehouse", 2.0, "Unknown", None),
    (None, "Warehouse", 2.0, "Unknown", None),
]


def test_movement_rules(spark):
    df = spark.createDataFrame([m[:3] for m in MOVES], "o string, d string, q double")
    got = df.select(
        movement_category(F.col("o"), F.col("d")).alias("c"), movement_quantity(F.col("o"), F.col("d"), F.col("q")).alias("q")
    ).collect()
    assert [(r["c"], r["q"]) for r in got] == [(m[3], m[4]) for m in MOVES]

