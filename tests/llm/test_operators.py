"""The other operators against brute force, round trips, the library, or held-out accuracy."""

import hashlib
import math
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kitwise.llm import hmm, html_text, imatch, licenses, mixing, pieces, quality, queries, topk, urls

from .conftest import documents

SF001 = "/root/testdata/sf0.01"
MODEL = f"{queries.TOKENIZERS}/{queries.MODEL}"
ODD = ["", "  a  b   c ", "\n\n x\t", "a" * 300, "▁x ▁", "日本語 テスト🎉 \x00", "</s> <s> <unk> <0x41>", " ", "don't%%% stop!!", "é ñ ß"]


# 1. SentencePiece ---------------------------------------------------------
def test_pieces_equal_the_library_and_decode(spark):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "word " * 40000, ODD[1]])]
    df = documents(spark, rows).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    got = pieces.encode(df, MODEL, parity=True)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(got, MODEL).collect()}
    library = pieces.library(open(MODEL, "rb").read(), False)
    for r in got.collect():
        text = rows[r["doc_id"]][1]
        assert r["decodes"] and r["same"]
        if text is None:
            assert r["ids"] is None and back[r["doc_id"]] is None and r["n_tokens"] == 0
        else:
            assert r["ids"] == library.encode(text) and back[r["doc_id"]] == text.replace("▁", " ")
    assert pieces.encode(df.limit(0), MODEL).count() == 0


def test_unit_table_forgets_and_finds_again(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 5)
    p = pieces.Pieces(open(MODEL, "rb").read())
    texts = [f"alpha beta w{i} gamma%%% w{i}" for i in range(30)]
    for t in texts + texts:
        ids, _, good = p.encode([t])
        assert good.all() and p.decode([ids.tolist()]) == [t]


# 2. URL filter ------------------------------------------------------------
URLS = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("HTTP://EXAMPLE.com/en/1?q=1#z", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://x.net/es/5", "x.net", "/es/5", "net/es/", "block"),
    ("https://notcom/", "notcom", "/", None, None),
    ("https://com", "com", "", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("x://?q", "", "", None, None),
]


def test_rules_and_hosts(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit("clash"))
    for r in urls.judge(df, queries.URL_RULES).collect():
        _, host, path, rule, verdict = URLS[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0
    none = urls.judge(df.where("page_id > 6"), queries.URL_RULES).collect()
    assert {r["verdict"] for r in none} == {"allow"}


def test_trees_on_held_out_urls(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url")
    truth = {r["page_id"]: r["verdict"] for r in urls.judge(pages, queries.URL_RULES).where("rule is not null").collect()}
    hidden = F.pmod(F.xxhash64("url"), F.lit(4)) == 0
    got = urls.judge(pages, queries.URL_RULES, hold_out=hidden).where("rule is null").collect()
    right = [r["verdict"] == truth[r["page_id"]] for r in got if r["page_id"] in truth]
    assert len(right) > 20 and np.mean(right) > 0.85


# 3. Top-k -----------------------------------------------------------------
def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 0.2, (700, 16))
    x[50:90] = x[50]  # ties
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 16), (903, [float("inf")]), (904, [0.5]), (905, []), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    q = {i: np.pad(np.floor(64 * np.array(v)), (0, 16 - len(v))) for i, v in rows if i is not None and i < 900 or i in (904, 905)}
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=20, n_pivots=8, n_centres=3, block_rows=100, query_rows=10).collect()
    want = {
        (a, rank + 1, b, s)
        for a in q if a % 20 == 0
        for rank, (s, b) in enumerate(sorted(((int(q[a] @ q[b]), b) for b in q if b != a), key=lambda p: (-p[0], p[1]))[:20])
    }
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)


def test_topk_small_and_large_numbers(spark):
    df = spark.createDataFrame([(0, [3e14, 1.0]), (1, [2.0, 5.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    big = math.floor(64 * 3e14)
    assert got[(0, 1)] == big * 128 + 64 * 320 and got[(20, 1)] == 64 * 128 + 64 * 320 and len(got) == 4
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# 5. Licences --------------------------------------------------------------
def test_licences(spark):
    rows = [
        (1, "Some prose here.\nReleased under the MIT License.\nMore prose."),
        (2, "released  under THE mit license"),
        (3, "Prose. Licensed under CC BY-NC 4.0. All rights reserved. More."),
        (4, "The rights of all are reserved by law in many a land."),
        (5, None), (6, ""), (7, "license"), (8, "word " * 30000), (9, "licensed under " * 20000),
    ]
    got = {r["doc_id"]: (r["n_matches"], r["license"], r["score"], r["licenses"]) for r in licenses.scan(documents(spark, rows).withColumn("license", F.lit(1))).collect()}
    assert got[1] == (1, "MIT", 1.0, "MIT") and got[2] == (1, "MIT", 1.0, "MIT")
    assert got[3] == (2, "ARR", 1.0, "ARR,CC-BY-NC-4.0")
    assert all(got[i] == (0, None, None, None) for i in range(4, 10))
    assert licenses.scan(documents(spark, rows).limit(0)).count() == 0


def test_every_match_has_an_anchor(spark):
    grams = licenses.template_bigrams(spark, licenses.TEMPLATES)
    for g in grams.values():
        own = licenses.anchors(g, 0.8)
        left = [x for x in g if not any(w in own for w in x.split(" "))]
        assert len(left) < len(g) * 0.8 / 1.2


def test_wrapped_and_in_sentence_notices(spark):
    prose = "Nothing of note is said in this long line of plain prose, which goes on.\n" * 40
    wrap = lambda name, mark, width: "\n".join(mark + x for x in textwrap.wrap(licenses.TEMPLATES[name], width))
    cases = [("GPL-3.0-notice", "# ", 60), ("BSD-3-Clause", " * ", 50), ("ISC", "// ", 40), ("MIT-text", "", 70), ("MIT-full", "", 78), ("Apache-2.0-notice", "-- ", 30)]
    rows = [(i, prose + wrap(*c) + "\n" + prose) for i, c in enumerate(cases)]
    rows += [(10, "this text is released under the MIT License and may be used by all"), (11, prose + licenses.TEMPLATES["GPL-3.0-full"] + prose),
             (12, prose), (13, "All rights reserved. " * 3000), (14, prose + wrap("GPL-3.0-notice", "# ", 60).replace("free software", "open software") + prose)]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, rows)).collect()}
    for i, (name, _, _) in enumerate(cases):
        assert name in got[i]["licenses"].split(",") and got[i]["score"] == 1.0
    assert (got[10]["license"], got[10]["score"], got[10]["n_matches"]) == ("MIT", 1.0, 1)
    assert {"GPL-3.0-full", "GPL-3.0-notice"} <= set(got[11]["licenses"].split(",")) and got[11]["score"] == 1.0
    assert got[12]["n_matches"] == 0 and got[13]["n_matches"] == 1
    assert got[14]["license"] == "GPL-3.0-notice" and 0.8 <= got[14]["score"] < 1


# 6. Quality ---------------------------------------------------------------
def test_quality_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    grades = queries.graded_labels(spark.read.parquet(f"{SF001}/labels.parquet"))
    hidden = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = quality.train(docs, grades.where(~hidden), 3)
    got = quality.grade(docs, model).join(grades.where(hidden), "doc_id").select("grade", "tail_prob", "expected_grade").collect()
    good = [r["tail_prob"] >= 0.5 for r in got if r["grade"] == 2]
    bad = [r["tail_prob"] < 0.5 for r in got if r["grade"] == 0]
    assert np.mean(good) > 0.9 and np.mean(bad) > 0.6 and list(model.thresholds) == sorted(model.thresholds)
    odd = documents(spark, [(1, None), (2, ""), (3, "word " * 30000), (3, "x")]).withColumn("tail_prob", F.lit("clash"))
    assert quality.grade(odd, model).count() == 4 and quality.select(odd, model, least=0.0).columns == odd.columns
    assert quality.train(docs, grades.limit(0), 3) is None
    clash = docs.withColumn("grade", F.lit("x"))
    assert np.allclose(quality.train(clash, grades.where(~hidden), 3).thresholds, model.thresholds, rtol=0.05)
    assert quality.grade(odd, None).where("tail_prob = 1").count() == 4


# 7. I-Match ---------------------------------------------------------------
def test_edited_texts_and_fingerprints(spark):
    base = [r[0] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").limit(40).collect()]
    texts = {3 * i: t for i, t in enumerate([*base, None, "", "x", "é🎉z", base[0]])}
    df = documents(spark, list(texts.items())).withColumn("fingerprint", F.lit("clash"))
    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(df).collect()}
    ids = sorted(texts)
    for i, following in zip(ids, [*ids[1:], ids[0]], strict=True):
        own, other = texts[i] or "", texts[following] or ""
        edited = own[: len(own) - len(own) // 2] + other[: len(own) // 2]
        assert got[i]["n_chars"] == len(own) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        assert (edited != own) or got[i]["near_edited"] == 1
    assert got[ids[-1]]["fingerprint"] == got[0]["fingerprint"]
    assert np.mean([r["near_edited"] for r in got.values()]) > np.mean([r["near_next"] for r in got.values()])


def test_fingerprints_of_repeated_and_missing_ids(spark):
    df = documents(spark, [(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (2, "a b")])
    got = imatch.edited_fingerprints(df).collect()
    assert len(got) == 5 and len({r["fingerprint"] for r in got if r["n_chars"] == 3}) == 1
    assert imatch.edited_fingerprints(df.limit(0)).count() == 0


def test_fingerprints_equal_plain_python(spark, monkeypatch):
    """Lexicon, subsets and likeness by sets of words; the lexicon as a constant and as a table."""
    rnd = np.random.default_rng(8)
    texts = [" ".join(f"w{w}" for w in rnd.zipf(1.4, rnd.integers(0, 60)) % 90) for _ in range(120)] + [None, "Rare words", ""]
    df = documents(spark, list(enumerate(texts))).repartition(3)
    words = [set((t or "").lower().split()) for t in texts]
    df_of = {w: sum(w in x for x in words) for w in set().union(*words)}
    band = {w for w, n in df_of.items() if 0.05 * len(texts) <= n <= 0.4 * len(texts)}
    keys = sorted(set().union(*words))
    hashes = dict(spark.createDataFrame([(w,) for w in keys], "w string").select("w", F.xxhash64("w")).collect())
    subset = lambda x, i, shift, bits: frozenset(w for w in x & band if (hashes[w] << shift & (1 << 64) - 1) >> (64 - bits) == i)

    def subsets(x):
        out, used = [], 0
        for bits, n in imatch.SUBSETS:
            out += [subset(x, i, used, bits) for i in range(n)]
            used += bits
        return out

    def like(x, y):
        if (x & band or x) == (y & band or y):
            return 1.0
        pairs = [(a, b) for a, b in zip(subsets(x), subsets(y), strict=True) if a or b]
        return sum(a == b for a, b in pairs) / len(pairs) if pairs else 0.0

    def check():
        got = {r["doc_id"]: r for r in imatch.edited_fingerprints(df, low=0.05, high=0.4).collect()}
        for i, t in enumerate(texts):
            j = (i + 1) % len(texts)
            own, other = t or "", texts[j] or ""
            edited = set((own[: len(own) - len(own) // 2] + other[: len(own) // 2]).lower().split())
            assert got[i]["near_next"] == pytest.approx(like(words[i], words[j])), i
            hashes.update(spark.createDataFrame([(w,) for w in edited - set(hashes)], "w string").select("w", F.xxhash64("w")).collect())
            assert got[i]["near_edited"] == pytest.approx(like(words[i], edited)), i

    monkeypatch.setattr(imatch, "SUBSETS", ((2, 3), (4, 5)))
    check()
    monkeypatch.setattr(imatch, "LEXICON", 3)
    check()


# 8. Mixing ----------------------------------------------------------------
def test_mix(spark):
    rows = [(i, "w " * (i % 9), f"s{i % 5}") for i in range(200)] + [(300, None, "s1"), (301, "a b", None), (None, "a b c", "s2"), (7, "x y", "s0"), (7, "x y", "s0")]
    df = documents(spark, rows).withColumn("size", F.lit("clash"))
    got = mixing.mix_plan(df).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    order = sorted(k for k in size if k is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, open_ = 1.5 * sum(size.values()), set(order)
    target = {}
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * size[s]}
        target.update({s: 2.0 * size[s] for s in full} if full else {s: weight[s] * level for s in open_})
        open_ -= full if full else open_
    taken = {}
    for r in got:
        assert r["source_size"] == size[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert len(got) == len(rows) and all(taken[s] == math.floor(target[s] + 1e-9) for s in order)
    mix = mixing.mixed(df)
    assert mix.columns == df.columns
    words = {r["source"]: r["n"] for r in mix.groupBy("source").agg(F.sum(mixing.words_in(F.col("text"))).alias("n")).collect()}
    assert all(abs(words.get(s, 0) - target[s]) <= 8 for s in order)
    assert mixing.mix_plan(df.limit(0)).count() == 0 and mixing.mix_plan(documents(spark, [(1, ""), (2, None)])).where("taken = 0").count() == 2


# 9. HTML ------------------------------------------------------------------
PROSE = "A long paragraph of prose, with commas, and full stops. It goes on for a while, as prose does; then it ends."
PAGES = [
    (f"<nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>{PROSE}<p><b>b\n c</b></article><footer>f</footer>", f"T & U\n{PROSE}\nb c"),
    (f"<div class=menu><p>{PROSE}</p></div><div id=content><h2>H</h2><p>{PROSE}</p><p>{PROSE}</p><blockquote>Q.</blockquote></div><div class='comments'><p>{PROSE}</p></div>", f"H\n{PROSE}\n{PROSE}\nQ."),
    (f"<script>var t='<p>';</script><!-- <p>no</p> --><main><p>{PROSE}</p></main><form><p>{PROSE}</p></form><aside>{PROSE}</aside>", PROSE),
    (f"<div class='page with-sidebar'><div class='cookie-notice'>{PROSE}</div><article><p>{PROSE}", PROSE),
    ("plain &lt;text&gt; only", "plain <text> only"), ("", ""), (None, ""), ("<p></p><div><br></div>", ""),
    ("<div>" * 3000 + PROSE, PROSE), ("<p>" + "word " * 50000, ("word " * 50000).strip()),
]


def test_main_text(spark):
    df = spark.createDataFrame([(i, "u", p[0]) for i, p in enumerate(PAGES)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    for r in html_text.extract(df).collect():
        assert r["text"] == PAGES[r["page_id"]][1] and r["n_chars"] == len(r["text"])
    assert html_text.extract(df.limit(0)).count() == 0


FRAMED = [
    (f"<div class='page has-sidebar'><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}"),
    (f"<div id='wrapper' class='no-sidebar'><div class='sidebar'><p>{PROSE}</p></div><div><h2>H</h2><p>{PROSE}</p><p>{PROSE}</p></div></div>", f"H\n{PROSE}\n{PROSE}"),
    (f"<div><a href=x>Skip</a></div><div class='layout sidebar-left'><div class='header-wide'><p>{PROSE}</p><p>{PROSE}</p></div><div class=footer>F.</div></div>", f"{PROSE}\n{PROSE}"),
    (f"<div class='post comments-open'><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}"),
    (f"<div id=content><p>{PROSE}</p></div><div class='comments'>" + f"<p>{PROSE}</p>" * 9 + "</div>", PROSE),
    (f"<article><p>{PROSE}</p></article><div class='cookie-consent'>" + f"<p>{PROSE}</p>" * 9 + "</div>", PROSE),
    (f"<article><div class='entry share-on'><p>{PROSE}</p><p>{PROSE}</p></div><div class=share><p>{PROSE}</p></div></article>", f"{PROSE}\n{PROSE}"),
    (f"<article><p>{PROSE} <span class='token comment'># c</span> <a class='social' href=x>us</a> x.</p></article>", f"{PROSE} # c us x."),
    (f"<article><p>{PROSE}<span hidden>a<span>b</span>c</span> <b style='display:none'>d</b>e</p></article>", f"{PROSE} e"),
    (f"<div class='sidebar'><p>{PROSE}</p></div><div class='menu'><p>{PROSE}</p></div>", ""),
]


def test_frames_named_after_a_part_and_inline_text():
    for page, text in FRAMED:
        assert html_text.main_text(page) == text, page


# 10. HMM ------------------------------------------------------------------
def plain_forward(seq, m):
    total, a = 0.0, None
    for s in seq:
        a = (m.start if a is None else a @ m.move) * m.emit[s]
        total += math.log(a.sum())
        a = a / a.sum()
    return total


def test_forward_and_counts():
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    m = hmm.Hmm(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 7))).T.copy())
    size = np.array([5, 1, 40, 5])
    seq = rng.integers(0, 7, size.sum())
    cut = np.cumsum(size)[:-1]
    assert hmm.forward(seq, size, m) == pytest.approx([plain_forward(s, m) for s in np.split(seq, cut)])
    starts, moves, emits, like = hmm.expected_counts(seq, size, m)
    assert like == pytest.approx(hmm.forward(seq, size, m).sum(), rel=1e-4)
    assert starts.sum() == pytest.approx(4, rel=1e-4) and moves.sum() == pytest.approx(size.sum() - 4, rel=1e-4)
    assert emits.sum(1) == pytest.approx(np.bincount(seq, minlength=7), rel=1e-4)


def test_counts_cross_segment_borders(monkeypatch):
    rng = np.random.default_rng(4)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    m = hmm.Hmm(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 7))).T.copy())
    size = np.array([5, 1, 43, 16, 8, 17])
    seq = rng.integers(0, 7, size.sum())
    starts, moves, emits, like = np.zeros(3), np.zeros((3, 3)), np.zeros((7, 3)), 0.0
    for o in np.split(seq, np.cumsum(size)[:-1]):
        a, b = [m.start * m.emit[o[0]]], [np.ones(3)]
        for x in o[1:]:
            a.append((a[-1] @ m.move) * m.emit[x])
        for x in o[:0:-1]:
            b.insert(0, m.move @ (m.emit[x] * b[0]))
        p = a[-1].sum()
        starts, like = starts + a[0] * b[0] / p, like + math.log(p)
        for t, x in enumerate(o):
            emits[x] += a[t] * b[t] / p
            if t:
                moves += np.outer(a[t - 1], m.emit[x] * b[t]) * m.move / p
    for segment in (128, 8, 3):
        monkeypatch.setattr(hmm, "SEGMENT", segment)
        got = hmm.expected_counts(seq, size, m)
        assert all(x == pytest.approx(y, rel=1e-4, abs=1e-5) for x, y in zip(got, (starts, moves, emits, like), strict=True))


def test_base_scores_and_held_out_gain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(300)
    docs = docs.unionByName(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "the the"), (5, "zzzqqq")], "doc_id long, text string"))
    docs = docs.withColumn("score", F.lit("clash"))
    rows = docs.collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = {}
    for r in rows:
        if not out(r["doc_id"]):
            for t in tokens(r["text"]):
                c[t] = c.get(t, 0) + 1
    n, v = sum(c.values()), len(c)
    want = sorted(
        (str(r["doc_id"]), out(r["doc_id"]), len(tokens(r["text"])), sum(t in c for t in tokens(r["text"])), n,
         round(sum(math.log10((c.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r["text"])), 6))
        for r in rows
    )
    # few common words, so that the join of rare words is used
    got = hmm.score_documents(docs, common=1 << 10, head=1 << 8).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hmm.score_documents(docs.limit(0)).count() == 0


def test_hash_lookup_finds_what_a_binary_search_finds():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 1000):
        table = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        table = np.unique(np.concatenate((table, table[:3] + np.uint64(1))))  # neighbours in one bucket
        values = np.concatenate((table, table + np.uint64(1), rng.integers(0, 1 << 64, 500, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)))
        assert (hmm.Lookup(table).find(values) == hmm._find(table, values)).all()
