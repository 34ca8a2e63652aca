"""Running demand by path against a plain Python walk over each path."""

import datetime as dt
import hashlib
import random

from kitwise.operators import coverage
from kitwise.sources.standins import PARAMS

W0 = PARAMS.week0


def plain(horizon, remaining, stock, transit):
    """(path, part, revision, week, demand, prior, covered by stock, with transit, by transit) rows."""
    demands = {}
    for part, rev, week, amount in sorted(remaining, key=lambda r: r[1] is not None):
        demands.setdefault((part, rev or "", (week - W0).days // 7), []).append(amount)
    queues = {}
    for path, part, rev, last in horizon:
        digest = hashlib.md5(f"{part}|{rev or ''}".encode()).hexdigest()
        for w in range(last + 1):
            for nth, d in enumerate(demands.get((part, rev or "", w), [0.0])):
                queues.setdefault(path, []).append((w, digest, part, rev is not None, rev or "", nth, rev, d))

    def covered(have, prior, need):
        if prior > have:
            return 0.0
        return 1.0 if need <= 0 or have - prior >= need else max(have - prior, 0.0) / need

    out = []
    for path, queue in queues.items():
        prior = 0.0
        for w, _, part, _, _, _, rev, d in sorted(queue, key=lambda q: q[:6]):
            s, t = stock.get(part, 0.0), transit.get(part, 0.0)
            by_transit = covered(t, prior, d) if t > 0 else 0.0
            out.append((path, part, rev, w, d, prior, covered(s, prior, d), covered(s + t, prior, d), by_transit))
            prior += d
    return sorted(out, key=str)


def spark_rows(spark, horizon, remaining, stock, transit):
    h = spark.createDataFrame(horizon, "path string, part_number string, revision string, max_week_offset int")
    r = spark.createDataFrame(remaining, "part_number string, revision string, demand_week date, week_demand double")
    lines = coverage.line_weeks(
        h,
        coverage.shared_paths(h),
        coverage.weekly_demand_map(r, PARAMS),
        spark.createDataFrame(list(stock.items()), "part_number string, on_hand_alt double"),
        spark.createDataFrame([], "path string, on_hand_in_parents double"),
        spark.createDataFrame(list(transit.items()), "part_number string, in_transit_alt double"),
    )
    rows = coverage.weekly_coverage(lines, PARAMS).select(
        "path", "part_number", "revision", "week_offset", "week_demand", "prior_demand",
        "week_coverage", "week_coverage_with_in_transit", "week_coverage_in_transit",
    )
    return sorted([tuple(x) for x in rows.collect()], key=str)


def week(n):
    return W0 + dt.timedelta(days=7 * n)


def test_both_spellings_of_a_revision_use_the_stock_one_after_the_other(spark):
    horizon = [("|R|P|", "P", None, 1), ("|R|A|P|", "P", "", 1)]
    remaining = [("P", "", week(0), 4.0), ("P", None, week(0), 2.0), ("P", "", week(1), 3.0)]
    got = spark_rows(spark, horizon, remaining, {"P": 5.0}, {})
    assert [r[4:7] for r in got if r[2] is None] == [(2.0, 0.0, 1.0), (4.0, 2.0, 0.75), (3.0, 6.0, 0.0)]
    assert got == plain(horizon, remaining, {"P": 5.0}, {})


def test_a_hot_path_and_small_shared_paths(spark):
    rng = random.Random(5)
    revisions = [None, "", "A", "B"]
    horizon = [("||", f"P{i}", revisions[i % 4], rng.randint(0, 3)) for i in range(1500)]
    horizon += [(f"|R|{i // 2}|", f"P{rng.randint(0, 40)}x{i}", rng.choice(revisions), 2) for i in range(60)]
    horizon += [(f"|S|{i}|", f"P{i}", revisions[i % 4], 103) for i in range(5)]
    remaining = [
        (part, r, week(w), float(rng.randint(0, 9)))
        for part in sorted({h[1] for h in horizon})
        for r in revisions
        for w in range(4)
        if rng.random() < 0.5
    ]
    stock = {h[1]: float(rng.randint(0, 20000)) for h in horizon if rng.random() < 0.7}
    transit = {h[1]: float(rng.randint(0, 9000)) for h in horizon if rng.random() < 0.5}
    got = spark_rows(spark, horizon, remaining, stock, transit)
    assert got == plain(horizon, remaining, stock, transit)


def test_no_lines(spark):
    assert spark_rows(spark, [], [], {}, {}) == []
