"""Near-duplicates against brute force; chains; edge cases."""

import math
import random
import tracemalloc
from fractions import Fraction

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kitwise.llm import neardup
from kitwise.llm.components import connected_components
from kitwise.llm.scratch import Scratch
from kitwise.llm.words import text_batches

SCHEMA = "doc_id long, text string, node string, sig string"  # clashing names on purpose


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    comp = {i: i for i, _ in sets if i is not None}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and len(a & b) * den >= len(a | b) * num:
                lo, hi = sorted((root(i), root(j)))
                comp[hi] = lo
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=str)


def found(spark, rows, **params):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = neardup.near_duplicates(df, **params).collect()
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus():
    rng = random.Random(4)
    rows, n = [], 0
    for size, members in ((60, 45), (120, 30), (200, 12)):  # groups above and below SMALL_BUCKET
        words = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(members):
            rows.append((n, edited(words, rng.choice((0, 0, 1, 2, 3, 5)), rng)))
            n += 1
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):  # each linked with the next only
        rows.append((n, " ".join(chain[4 * i :] + [f"d{j}" for j in range(4 * i)])))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, "É é")]
    rows += [(n + 7, "long " + "word " * 30000), (n + 8, rows[0][1]), (n + 8, rows[0][1]), (None, rows[0][1])]
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    for k, t, num in ((3, "0.85", 17), (5, "0.8", 16)):
        assert found(spark, rows, k=k, threshold=t) == brute(rows, k, num, 20)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "z"), (3, "z"), (None, "a b c d e f g"), (5, None)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = neardup.without_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in got.collect())) == ["1", "3", "5"]  # the copy without an id goes too


def test_an_id_with_two_texts_links_both_their_groups(spark):
    """Component ids over all rows of an id; rows of one id with unrelated texts both stay in the filter."""
    text = {c: " ".join(f"{c}{i}" for i in range(12)) for c in "ABCD"}
    rows = [(3, "A"), (5, "A"), (5, "B"), (7, "B"), (9, "C"), (8, "D"), (8, "D"), (None, "D"), (None, "A")]
    df = spark.createDataFrame([(i, text[t], "x", t) for i, t in rows] + [(7, "", "x", ""), (None, "", "x", "")], SCHEMA)
    got = {(r["doc_id"], r["component_id"]) for r in neardup.near_duplicates(df, k=3, threshold="0.85").collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (9, 9), (8, 8), (None, None)}
    clash = df.withColumn("_nth", F.lit("own")).withColumn("_hash", F.lit("own")).withColumn("_key", F.lit(1))
    left = neardup.without_near_duplicates(clash)
    assert left.columns == clash.columns and left.where("_nth = 'own' AND _hash = 'own'").count() == left.count()
    assert sorted(left.select("doc_id", "sig").collect(), key=str) == sorted(
        [(3, "A"), (5, "B"), (9, "C"), (8, "D"), (7, ""), (None, "")], key=str)
    assert neardup.without_near_duplicates(clash.limit(0)).count() == 0
    short = neardup.near_duplicates(df.withColumn("doc_id", F.col("doc_id").cast("short")), k=3, threshold="0.85").collect()
    assert {(r["doc_id"], r["component_id"]) for r in short} == got


def test_texts_are_hashed_a_few_at_a_time():
    texts = ["é" * 60, None, "", "a" * 500, "b", None]
    got = list(text_batches(pa.array(texts), 130))
    assert [(lo, hi) for lo, hi, _ in got] == [(0, 3), (3, 4), (4, 6)] and sum((t for _, _, t in got), []) == texts
    assert not list(text_batches(pa.array([], pa.string()), 130))
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=500)) for _ in range(2000)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts), pa.array(range(2000))], names=["id", "text", "text_hash"])
    run = neardup._sketch(3, 140, 17, pa.int64())
    list(run(iter([rows.slice(0, 1)])))
    tracemalloc.start()
    n = sum(out.num_rows for out in run(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2000 and peak < 48 << 20  # 2 MB of text


def test_signatures_and_bands_miss_less_than_they_may():
    for t, n in ((Fraction("0.8"), 200), (Fraction("0.85"), 140)):
        k = neardup.least_agreeing(n, t, 5e-8)
        below = sum(math.comb(n, i) * float(t) ** i * (1 - float(t)) ** (n - i) for i in range(k))
        assert below <= 5e-8 < below + math.comb(n, k) * float(t) ** k * (1 - float(t)) ** (n - k)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
def test_components_match_union_find(spark, edges):
    comp = {i: i for e in edges for i in e}
    for _ in comp:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    want = {n: c for n, c in comp.items() if any(a != b and n in (a, b) for a, b in edges)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)


def test_long_chain(spark):
    got = connected_components(spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long"), Scratch(spark))
    assert {(r["component"]) for r in got.collect()} == {0}


def test_bands_meet_the_miss_rate():
    for t in (0.8, 0.85):
        assert (1 - t**neardup.ROWS) ** neardup.bands_for(t) <= 1e-7
