"""Ancestor pairs by intervals against the literal prefix test."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kitwise.operators.intervals import prefix_pairs

PART = st.sampled_from(["A", "B", "AB", "é", "\U0010ffff", "B01", ""])
PATH = st.one_of(st.none(), st.builds(lambda p, end: "|" + "|".join(p) + end, st.lists(PART, max_size=6), st.sampled_from(["", "|"])))
ROWS = st.lists(st.tuples(st.sampled_from(["r", "s", None]), st.sampled_from(["", "1"]), PATH), min_size=1, max_size=40)


def literal(rows, ancestors):
    out = Counter()
    for i, (root, key, path) in enumerate(rows):
        for j, (a_root, a_key, a_path) in ancestors:
            if None not in (root, path, a_path) and (root, key) == (a_root, a_key) and path != a_path and path.startswith(a_path):
                out[(i, j)] += 1
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, levels=st.sampled_from([(4, 8, 12, 16), (0, 1), (2,)]), modulus=st.integers(1, 3))
def test_pairs_equal_the_literal_prefix_join(spark, rows, levels, modulus):
    ancestors = [(i % 4, r) for i, r in enumerate(rows) if i % modulus == 0]
    schema = "root string, rev string, path string"
    lines = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, line int")
    anc = spark.createDataFrame([(*r, j) for j, r in ancestors], f"{schema}, anc int")
    got = Counter((r["line"], r["anc"]) for r in prefix_pairs(lines, anc, ["root", "rev"], "path", levels).collect())
    assert got == literal(rows, ancestors)


def test_one_root_with_most_lines_is_spread_over_bins(spark):
    """A bin has no more rows than the widest level, whatever the size of the root."""
    paths = [f"|R|S{i % 7}|P{i}|" for i in range(3000)] + [f"|R|S{i}|" for i in range(7)] + ["|R|"]
    lines = spark.createDataFrame([("R", "", p, p) for p in paths], "root string, rev string, path string, line string")
    anc = lines.where(F.length("path") < 8).select("root", "rev", "path", F.col("line").alias("anc"))
    pairs = prefix_pairs(lines, anc, ["root", "rev"], "path", (3, 6))
    assert pairs.count() == 3000 * 2 + 7
    assert prefix_pairs(lines.limit(0), anc.limit(0), ["root", "rev"], "path").count() == 0
