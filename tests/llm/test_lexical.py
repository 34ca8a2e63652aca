"""Ranked lexical search against plain Python and DuckDB."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kitwise.llm import lexical, oracle, queries

from .conftest import documents

from compare import compare, duck

SF001 = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document for every item."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, length = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in counts:
            m = 10 + (90 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            scored += [(-score, d is not None, d)] if score > 0 else []
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored)[:k])]
    return out


def test_terms():
    text = "The-QUICK_brown9 Ünder\x7fé\x00ſ ÀB{x}İ"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)
    assert lexical.terms_of(None) == [] and lexical.terms_of(b" .-\n") == []


@pytest.mark.parametrize("leaf", [1, 16])
def test_tree_finds_the_best_and_leaves_out_the_rest(leaf, monkeypatch):
    monkeypatch.setattr(lexical, "LEAF", leaf)
    rnd = random.Random(3)
    for size in (1, 2, 40, 700):
        vectors = [sorted(rnd.sample(range(60), min(rnd.randint(1, 9), 60))) for _ in range(size)]
        vectors += vectors[: size // 3]
        tf = [[rnd.choice((1, 1, 1, 2, 5)) for _ in v] for v in vectors]
        m = [rnd.randint(10, 200) for _ in vectors]
        flat = lambda x: np.array([e for v in x for e in v], np.int64)
        tree = lexical.Tree(list(range(len(vectors))), np.array(m), np.array([len(v) for v in vectors]), flat(vectors), flat(tf))
        for _ in range(20):
            weight = np.zeros(60, np.int64)
            weight[rnd.sample(range(60), 8)] = [rnd.randint(0, 9000) for _ in range(8)]
            want = [(-sum(int(weight[t]) * ((10**9 * f) // (1000 * f + 8 * m[i])) for t, f in zip(v, tf[i], strict=True)), (True, i))
                    for i, v in enumerate(vectors)]
            assert tree.search(weight, [], 10) == sorted(w for w in want if w[0])[:10]


def test_bounds_leave_out_nodes(monkeypatch):
    """Documents under a prefix that can't reach the tenth best score are never scored."""
    rank = np.array([t for i in range(1000) for t in ((0, 2 + i % 5) if i < 50 else (1, 7 + i % 40))], np.int64)
    tree = lexical.Tree(list(range(1000)), np.full(1000, 50), np.full(1000, 2), rank, np.ones(2000, np.int64))
    weight = np.zeros(60, np.int64)
    weight[0], weight[2], weight[1] = 5000, 9000, 1
    opened = []
    monkeypatch.setattr(tree, "lo", type("Seen", (list,), {"__getitem__": lambda self, i: opened.append(i) or list.__getitem__(self, i)})(tree.lo))
    assert len(tree.search(weight, [], 10)) == 10
    assert len(opened) <= 2 < len(tree.children)


def test_query_equals_plain_python(spark, monkeypatch):
    rnd = random.Random(11)
    words = ["the", "of", "é", "ÀB", "zinc", "9", "Ox-bow", "rare", "x_y"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rnd.choices(words, weights=[9, 9, 4, 2, 1, 2, 1, 1, 1] + [0.3] * 60, k=n))
    docs = [(i, text(rnd.randint(0, 40))) for i in range(400)] + [(7, text(9)), (None, "zinc rare"), (900, None), (901, " .- "), (902, "")]
    docs += [(1000 + i, "rare ox zinc") for i in range(30)] + [(950, "the " * 30000 + "rare")]
    items = [(i, text(rnd.randint(1, 12))) for i in range(12)] + [(50, None), (51, ""), (None, "zinc"), (52, "nowhere"), (53, "rare zinc ox")]
    d = documents(spark, docs).withColumnRenamed("lang", "n").withColumnRenamed("source", "terms")
    b = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(plain(docs, items), key=key)
    assert sorted(map(tuple, lexical.rank(d, b).collect()), key=key) == want
    monkeypatch.setattr(lexical, "ITEM_CHARS", 40)  # several passes
    assert sorted(map(tuple, lexical.rank(d, b).collect()), key=key) == want
    assert lexical.rank(d, b.limit(0)).count() == 0 and lexical.rank(d.limit(0), b).count() == 0


def test_query_equals_its_sql(spark):
    assert compare(queries.op13_lexical(spark, SF001), duck(SF001), oracle.LEXICAL) == []
