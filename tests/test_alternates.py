"""Group-decomposed sums over alternates against the plain pair list."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kitwise.operators.alternates import (
    alternate_bridge,
    alternate_classes,
    alternate_groups,
    alternates_of,
    class_links,
    latest_over_alternates,
    sum_over_alternates,
)

PARTS = [f"P{i}" for i in range(8)]


def brute(groups, base, values):
    out = {}
    for b in base:
        gs = [set(g) for g in groups if b in g]
        rel = set().union(*gs) if gs else {b}
        out[b] = sum(values.get(r, 0.0) for r in rel)
    return out


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from(PARTS), min_size=1, max_size=4), min_size=0, max_size=5),
    st.dictionaries(st.sampled_from(PARTS), st.integers(0, 9)),
)
def test_sum_over_alternates_matches_pairs(spark, groups, values):
    sheet = spark.createDataFrame(
        [(i, ", ".join(g)) for i, g in enumerate(groups)] or [(99, "")], "row_id bigint, part_numbers string"
    )
    g = alternate_groups(sheet)
    base = spark.createDataFrame([(p,) for p in PARTS], "part_number string")
    metrics = spark.createDataFrame(
        [(k, float(v)) for k, v in values.items()] or [("none", 0.0)], "part_number string, x double"
    )
    got = {r["part_number"]: r["x"] for r in sum_over_alternates(base, g, metrics, ["x"]).collect()}
    clean = [[p.strip() for p in grp if p.strip()] for grp in groups]
    assert got == brute(clean, PARTS, {k: float(v) for k, v in values.items()})

    # The pair list gives the same sums.
    pairs = alternate_bridge(base, g).join(
        metrics.withColumnRenamed("part_number", "related_part_number"), "related_part_number", "left"
    )
    via_pairs = {
        r["base_part_number"]: r["s"]
        for r in pairs.groupBy("base_part_number").agg(F.sum(F.coalesce("x", F.lit(0.0))).alias("s")).collect()
    }
    assert via_pairs == got

    some = base.where(F.col("part_number") < "P4")
    others = {r["related_part_number"] for r in alternate_bridge(some, g).collect() if r["related_part_number"] != r["base_part_number"]}
    assert {r["part_number"] for r in alternates_of(some, g).collect()} == others

    latest = metrics.select("part_number", F.struct(F.col("x").alias("v")).alias("m"))
    lat = {r["part_number"]: r["m"]["v"] for r in latest_over_alternates(base, g, latest, "m").collect()}
    for b in PARTS:
        gs = [set(x) for x in clean if b in x]
        rel = set().union(*gs) if gs else {b}
        vals = [float(values[r]) for r in rel if r in values]
        assert lat.get(b) == (max(vals) if vals else None)


def test_large_groups_that_share_half_their_parts_make_no_pairs(spark):
    """Two groups of 10,000 parts, 5,000 of them in both: three classes, seven links, exact sums."""
    names = [f"N{i}" for i in range(15000)]
    sheet = [(1, ",".join(names[:10000])), (2, ",".join(names[5000:])), (3, "X1, X2"), (4, "")]
    groups = alternate_groups(spark.createDataFrame(sheet, "row_id bigint, part_numbers string"))
    classes = alternate_classes(groups)
    links = class_links(groups, classes)
    assert classes.select("class").distinct().count() == 4 and links.count() == 7 + 1
    base = spark.createDataFrame([(p,) for p in [*names, "X1", "Y"]], "part_number string")
    metrics = base.select("part_number", F.expr("CASE WHEN part_number = 'N0' THEN NULL ELSE length(part_number) END").cast("double").alias("x"))
    got = dict(sum_over_alternates(base, groups, metrics, ["x"], classes=classes, links=links).collect())
    sizes = {p: float(len(p)) if p != "N0" else 0.0 for p in names}
    first, second = sum(sizes[p] for p in names[:10000]), sum(sizes[p] for p in names[5000:])
    assert {got[p] for p in names[:5000]} == {first} and {got[p] for p in names[10000:]} == {second}
    assert {got[p] for p in names[5000:10000]} == {sum(sizes.values())} and got["X1"] == 2.0 and got["Y"] == 1.0
    # the joins that expand rows are those of classes: no row count is near that of pairs
    plan = sum_over_alternates(base, groups, metrics, ["x"])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def _components(sets):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s in sets:
        for p in s:
            find(p)
        for p in s[1:]:
            a, b = find(s[0]), find(p)
            if a != b:
                parent[max(a, b)] = min(a, b)
    comp = {p: find(p) for p in parent}
    sizes = {}
    for c in comp.values():
        sizes[c] = sizes.get(c, 0) + 1
    return {p: (min(q for q in comp if comp[q] == c), sizes[c]) for p, c in comp.items()}


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(PARTS),
            st.lists(st.sampled_from(PARTS), max_size=3),
            st.lists(st.sampled_from(PARTS), max_size=2),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_alternate_components_match_union_find(spark, rows):
    from kitwise.operators.components import alternate_components

    df = spark.createDataFrame(
        [(p, ", ".join(a), ",".join(g), None) for p, a, g in rows],
        "part_number string, alternates_text string, global_alternate_part_numbers string, "
        "substitute_part_numbers string",
    )
    got = {r["part_number"]: (r["component"], r["component_size"]) for r in alternate_components(df).collect()}
    sets = [sorted({p, *a, *g}, key=lambda x: ([p, *a, *g].index(x))) for p, a, g in rows]
    assert got == _components(sets)


def test_long_chain_is_one_component(spark):
    """A chain of 500 parts, its smallest label at one end and the others falling towards it."""
    from kitwise.operators.components import alternate_components

    names = ["A0000", *[f"P{9999 - i}" for i in range(499)]]
    rows = [(a, b, None, None) for a, b in zip(names, names[1:], strict=False)]
    df = spark.createDataFrame(
        rows, "part_number string, alternates_text string, global_alternate_part_numbers string, substitute_part_numbers string"
    )
    got = alternate_components(df).collect()
    assert len(got) == 500 and {(r["component"], r["component_size"]) for r in got} == {("A0000", 500)}
