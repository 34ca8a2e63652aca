"""Near-duplicate documents: MinHash minima, banding, exact verification, components.

1. Each text's set of k-word shingles (64-bit hashes) gives many universal hash
   minima h(x) = (a*x + b) mod 2**64. Texts with equal sets form one class; the
   rest of the work is on one representative of each class.
2. Bands of minima put representatives in buckets. The number of bands follows
   from the wanted chance of missing a pair at the threshold (``miss``).
3. Every member of a bucket is paired with the bucket's leader (its member that
   shares buckets with most others), never with every other member. Signatures
   (agreeing minima) drop hopeless pairs, and full shingle sets confirm the rest.
   Components of the confirmed links already join most of each group.
4. Only pairs of one bucket in *different* components can still change the
   answer. Small buckets emit these pairs (each member has at most
   ``SMALL_BUCKET`` - 1 others). Members of large buckets are compared in blocks:
   the largest component of such a group against all others, and the others
   among themselves. A block emits confirmed links only, one for each text and
   component, so no pair list of a group is ever made and no pair is skipped.
5. Components of all confirmed links by alternating large-star and small-star.

Edge cases: a null or empty text, or one without words, has an empty set and is
linked with nothing (its component is its own id). Rows with a null id keep a
null component, are linked with nothing and are kept. Rows that repeat an id
are one node: links of any of them count. Columns other than the id and the
text are not read. ``without_near_duplicates`` looks at rows instead of ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kitwise.llm.components import connected_components
from kitwise.llm.scratch import Scratch
from kitwise.llm.words import Words, mix, shingles, text_batches

#: Minima in a band.
ROWS = 5
#: Buckets up to this size emit their remaining pairs; larger ones are compared in blocks.
SMALL_BUCKET = 16
#: Shingles in a block of the blockwise comparison (8 bytes each).
BLOCK_SHINGLES = 1 << 18
#: Members compared with one leader in one task.
LEADER_CHUNK = 256
#: Bytes of text that a task has in an Arrow batch, and that it hashes at once (some 60 times as many in use).
ARROW_BYTES, HASHED = 1 << 22, 1 << 18


def least_agreeing(n: int, threshold: Fraction, miss: float) -> int:
    """The largest number of agreeing minima (of ``n``) that a pair at the threshold falls short of with chance ``miss`` at most."""
    t = float(threshold)
    chance, k = 0.0, 0
    while k <= n and (chance := chance + math.comb(n, k) * t**k * (1 - t) ** (n - k)) <= miss:
        k += 1
    return k


def bands_for(threshold: Fraction, rows: int = ROWS, miss: float = 1e-7) -> int:
    """The fewest bands that miss a pair at the threshold with at most this probability."""
    return math.ceil(math.log(miss) / math.log1p(-(float(threshold) ** rows)))


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def _sketch(k: int, n_minima: int, seed: int, id_type: pa.DataType):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(n_minima, seed)
        for part in parts:
            ids = part.column(0)
            for lo, hi, texts in text_batches(part.column(1), HASHED):
                doc, value = shingles(Words(texts), k)
                n = np.bincount(doc, minlength=hi - lo).astype(np.int64)
                full = np.flatnonzero(n)
                h = np.zeros((2, hi - lo), np.uint64)
                sig = np.zeros((hi - lo, n_minima), np.int32)
                if len(full):
                    at = (np.cumsum(n) - n)[full]
                    h[0, full] = np.add.reduceat(mix(value), at)
                    h[1, full] = np.add.reduceat(mix(value ^ np.uint64(0xA0761D6478BD642F)), at)
                    out = np.empty((n_minima, len(full)), np.uint32)
                    for i in range(n_minima):
                        out[i] = np.minimum.reduceat(value * a[i] + b[i], at) >> np.uint64(32)
                    sig[full] = out.T.view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo).cast(id_type),
                        part.column(2).slice(lo, hi - lo),
                        pa.array(n),
                        pa.array(h[0].view(np.int64)),
                        pa.array(h[1].view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(hi - lo + 1, dtype=np.int32) * n_minima), pa.array(sig.ravel())
                        ),
                    ],
                    names=["id", "text_hash", "n", "h1", "h2", "sig"],
                )

    return run


def _sets(k: int, id_type: pa.DataType):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column(0)
            for lo, hi, texts in text_batches(part.column(1), HASHED):
                doc, value = shingles(Words(texts), k)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo).cast(id_type),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(value.view(np.int64))),
                    ],
                    names=["node", "set"],
                )

    return run


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All elements of all sets in order, with the set each is from."""
    values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    return values[order], owner[order]


def _shared(one: np.ndarray, values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of one set with each of n indexed sets."""
    lo, hi = np.searchsorted(values, one, "left"), np.searchsorted(values, one, "right")
    size = hi - lo
    lo, size = lo[size > 0], size[size > 0]
    if not len(lo):
        return np.zeros(n, np.int64)
    at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
    return np.bincount(owner[at], minlength=n)


def _star(num: int, den: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        leaders = [np.asarray(s) for s in rows.loc[rows["lead"], "set"]]
        members = rows[~rows["lead"]]
        sets = [np.asarray(s) for s in members["set"]]
        values, owner = _index(sets)
        size = np.array([len(s) for s in sets], np.int64)
        ok = np.zeros(len(sets), bool)
        for one in leaders:
            both = _shared(one, values, owner, len(sets))
            ok |= both * den >= (size + len(one) - both) * num
        nodes = members["node"][ok].drop_duplicates()
        return pd.DataFrame({"a": [key[0]] * len(nodes), "b": nodes.to_numpy()}, columns=["a", "b"])

    return run


def _tile(num: int, den: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        first, second = key[2], key[3]
        left = rows[rows["place"] == first] if key[1] == "O" else rows[rows["place"] < 0]
        right = rows[rows["place"] == second]
        sets = [np.asarray(s) for s in left["set"]]
        values, owner = _index(sets)
        size = np.array([len(s) for s in sets], np.int64)
        nodes, comps = left["node"].to_numpy(), left["comp"].to_numpy()
        out_a, out_b = [], []
        for node, comp, one in zip(right["node"], right["comp"], right["set"], strict=True):
            one = np.asarray(one)
            both = _shared(one, values, owner, len(sets))
            hit = np.flatnonzero((both * den >= (size + len(one) - both) * num) & (comps != comp))
            if len(hit):
                _, once = np.unique(comps[hit], return_index=True)
                out_a += nodes[hit[once]].tolist()
                out_b += [node] * len(once)
        return pd.DataFrame({"a": out_a, "b": out_b}, columns=["a", "b"])

    return run


class _Search:
    """The tables of one run; ``kind`` is the id's type."""

    def __init__(self, docs: DataFrame, k: int, threshold: Fraction, miss: float, seed: int):
        self.scratch = Scratch(docs.sparkSession)
        self.docs, self.k, self.threshold, self.seed = docs, k, threshold, seed
        # half of the chance of a miss goes to the bands, half to the signatures
        self.bands = bands_for(threshold, miss=miss / 2)
        self.least_agreeing = least_agreeing(self.bands * ROWS, threshold, miss / 2)
        self.kind = docs.schema["id"].dataType
        self.arrow = to_arrow_type(self.kind)
        self.link_type = T.StructType([T.StructField("a", self.kind), T.StructField("b", self.kind)])

    def sketches(self) -> DataFrame:
        out = T.StructType(
            [
                T.StructField("id", self.kind),
                T.StructField("text_hash", T.LongType()),
                T.StructField("n", T.LongType()),
                T.StructField("h1", T.LongType()),
                T.StructField("h2", T.LongType()),
                T.StructField("sig", T.ArrayType(T.IntegerType())),
            ]
        )
        run = _sketch(self.k, self.bands * ROWS, self.seed, self.arrow)
        return self.scratch.save(self.docs.mapInArrow(run, out), "sketches", arrow_bytes=ARROW_BYTES)

    def classes(self, sketches: DataFrame) -> DataFrame:
        """One row for each distinct shingle set; node: the smallest id that has it."""
        own = sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
        per = own.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        return self.scratch.save(per, "classes")

    def members(self, classes: DataFrame) -> DataFrame:
        """(key, node, m): buckets of at least two nodes and their sizes."""
        band = F.transform(
            F.sequence(F.lit(0), F.lit(self.bands - 1)), lambda i: F.xxhash64(i, F.slice("sig", i * ROWS + 1, F.lit(ROWS)))
        )
        rows = classes.select("node", F.explode(band).alias("key"))
        shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
        return self.scratch.save(rows.join(shared, "key"), "members")

    def likely(self, pairs: DataFrame, mates: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and signatures allow, with the number of agreeing minima."""
        t = self.threshold
        side = lambda x: mates.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
        small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        agree = F.aggregate(
            F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
        )
        return (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .where(small * t.denominator >= large * t.numerator)
            .select("a", "b", agree.alias("agree"))
            .where(F.col("agree") >= self.least_agreeing)
            .groupBy("a", "b")
            .agg(F.max("agree").alias("agree"))
        )

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold. A leader's many members are dealt over chunks."""
        degree = pairs.groupBy("a").agg(F.count("*").alias("degree"))
        chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("degree") / LEADER_CHUNK)).cast("long")
        dealt = pairs.join(degree, "a").select("a", "b", chunk.alias("chunk"))
        has = sets.select("node", "set")
        members = dealt.join(has, dealt["b"] == has["node"]).select("a", "chunk", "node", "set", F.lit(False).alias("lead"))
        leads = dealt.select("a", "chunk").distinct()
        leads = leads.join(has, leads["a"] == has["node"]).select("a", "chunk", "node", "set", F.lit(True).alias("lead"))
        run = _star(self.threshold.numerator, self.threshold.denominator)
        return members.unionByName(leads).groupBy("a", "chunk").applyInPandas(run, self.link_type)

    def tiles(self, rest: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between different components among the members of large buckets, compared in blocks."""
        first = rest.groupBy("key").agg(F.min("node").alias("b"))
        group = connected_components(rest.join(first, "key").select(F.col("node").alias("a"), "b"), self.scratch, "groups")
        has = sets.select("node", "set", F.size("set").cast("long").alias("size"))
        # (group, node, comp): a group's largest component is compared with all others, not with itself
        own = rest.select("node", "comp").distinct().join(group, "node").withColumnRenamed("component", "grp")
        by_comp = own.join(has.select("node", "size"), "node").groupBy("grp", "comp").agg(F.sum("size").alias("size"))
        most = by_comp.groupBy("grp").agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("all"))
        blocks = lambda c: F.greatest(F.lit(1), F.ceil(c / BLOCK_SHINGLES)).cast("int")
        most = most.select(
            "grp",
            F.col("top.comp").alias("main"),
            blocks(F.col("top.size")).alias("n_main"),
            blocks(F.col("all") - F.col("top.size")).alias("n_rest"),
        )
        placed = own.join(most, "grp").withColumn("is_main", F.col("comp") == F.col("main"))
        block = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        tile = lambda kind, i, j, place: F.struct(
            F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), place.cast("int").alias("place")
        )
        b = F.col("block")
        main_tiles = F.transform(upto(F.col("n_rest")), lambda j: tile("L", b, j, F.lit(-1)))
        rest_tiles = F.concat(
            F.transform(upto(F.col("n_main")), lambda i: tile("L", i, b, b)),
            F.transform(upto(F.col("n_rest")), lambda j: tile("O", F.least(b, j), F.greatest(b, j), b)),
        )
        dealt = placed.withColumn("block", block).select(
            "grp", "node", "comp", F.explode(F.when(F.col("is_main"), main_tiles).otherwise(rest_tiles)).alias("t")
        )
        rows = dealt.join(has.select("node", "set"), "node").select("grp", "t.*", "node", "comp", "set")
        run = _tile(self.threshold.numerator, self.threshold.denominator)
        return rows.groupBy("grp", "kind", "i", "j").applyInPandas(run, self.link_type)


def _linked(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float | str | Fraction, miss: float, seed: int):
    """(search, sketches of all rows, (h1, h2, node, component) of every shingle set that a row with an id has)."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    s = _Search(rows, k, Fraction(str(threshold)), miss, seed)
    scratch = s.scratch
    sketches = s.sketches()
    classes = s.classes(sketches)
    members = s.members(classes)

    popular = members.groupBy("node").agg(F.sum("m").alias("pop"))
    # one row for each node: rows that repeat an id with another text keep all their signatures
    mates = scratch.save(classes.join(popular, "node").select("node", "n", "sig", "pop"), "mates")
    texts = (
        s.docs.select(F.col("id").alias("node"), "text")
        .join(mates.select("node").distinct(), "node", "left_semi")
        .groupBy("node", F.xxhash64("text").alias("h"))
        .agg(F.first("text").alias("text"))
        .select("node", "text")
    )
    set_type = T.StructType([T.StructField("node", s.kind), T.StructField("set", T.ArrayType(T.LongType()))])
    sets = scratch.save(texts.mapInArrow(_sets(k, s.arrow), set_type), "sets", arrow_bytes=ARROW_BYTES)

    # each member against the leaders of its buckets: its two likeliest ones
    pop = mates.groupBy("node").agg(F.max("pop").alias("pop"))
    lead = members.join(pop, "node").groupBy("key").agg(F.min(F.struct(-F.col("pop"), F.col("node"))).alias("lead"))
    pairs = members.join(lead, "key").select(F.col("lead.node").alias("a"), F.col("node").alias("b"))
    likely = s.likely(pairs.where("a != b").distinct(), mates)
    best = Window.partitionBy("b").orderBy(F.col("agree").desc(), "a")
    tried = scratch.save(likely.withColumn("rn", F.row_number().over(best)).where("rn <= 2").select("a", "b"), "tried")
    links = scratch.save(s.confirmed(tried, sets), "links-1")
    comp = connected_components(links, scratch, "first")

    # what is left: pairs of a bucket in different components
    placed = members.join(comp, "node", "left").select("key", "m", "node", F.coalesce("component", "node").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    rest = scratch.save(placed.join(mixed, "key"), "rest")
    small = rest.where(F.col("m") <= SMALL_BUCKET)
    other = small.select("key", F.col("node").alias("b"), F.col("comp").alias("comp_b"))
    open_pairs = (
        small.join(other, "key")
        .where((F.col("node") < F.col("b")) & (F.col("comp") != F.col("comp_b")))
        .select(F.col("node").alias("a"), "b")
        .distinct()
    )
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    open_pairs = scratch.save(s.likely(open_pairs.join(done, ["a", "b"], "left_anti"), mates).select("a", "b"), "open")
    more = scratch.save(s.confirmed(open_pairs, sets), "links-2")
    large = rest.where(F.col("m") > SMALL_BUCKET).select("key", "node", "comp")
    tiled = scratch.save(s.tiles(large, sets), "links-3")

    final = connected_components(links.unionByName(more).unionByName(tiled), scratch, "final")
    by_class = classes.select("h1", "h2", "node").join(final, "node", "left")
    by_class = by_class.select("h1", "h2", "node", F.coalesce("component", "node").alias("component"))
    return s, sketches, scratch.save(by_class, "by-class")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    threshold: float | str | Fraction = "0.8",
    miss: float = 1e-7,
    seed: int = 17,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``.

    Texts are linked if the Jaccard similarity of their k-word shingle sets is
    at least ``threshold``; a linked pair goes unseen with probability ``miss``
    at most, and every link is confirmed on the full sets. ``component_id`` is
    the smallest id reachable over links, ``kept`` marks the rows that have it.
    """
    s, sketches, by_class = _linked(docs, id_col, text_col, k, threshold, miss, seed)
    scratch = s.scratch
    full = (F.col("n") > 0) & F.col("id").isNotNull()
    placed = sketches.where(full).join(by_class, ["h1", "h2"]).select("id", "n", "component")
    # rows without a set or an id would all meet on one null key
    rest = sketches.where(~full).select("id", "n", F.col("id").alias("component"))
    placed = scratch.save(placed.unionByName(rest), "placed")
    # an id with texts of different components links these
    ends = placed.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("hi"))
    joint = scratch.save(ends.where("a != hi").select("id", "a"), "joint")
    if not joint.isEmpty():
        links = placed.join(joint, "id").select("a", F.col("component").alias("b"))
        joined = connected_components(scratch.save(links.distinct(), "joint-links"), scratch, "joint")
        joined = scratch.save(joined, "joined").withColumnRenamed("component", "whole")
        placed = placed.join(joined, placed["component"] == joined["node"], "left")
        placed = placed.select("id", "n", F.coalesce("whole", "component").alias("component"))
    out = placed.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
    out = scratch.save(out, "result")
    scratch.keep_only("result")
    return out


def without_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    threshold: float | str | Fraction = "0.8",
    miss: float = 1e-7,
    seed: int = 17,
) -> DataFrame:
    """The rows of ``docs``, whole, with one row of each group of near-duplicates: that of the smallest id, null last.

    Here rows are what is compared: those that repeat an id with another text
    are documents of their own. Rows with a null id are compared with the others
    by their shingle sets: copies of a text that another row has go, with or
    without an id. Near (not equal) texts of which all rows lack an id stay, and
    so do texts without words.
    """
    s, sketches, by_class = _linked(docs, id_col, text_col, k, threshold, miss, seed)
    scratch = s.scratch
    rows = sketches.where("n > 0").select("id", "text_hash", "h1", "h2")
    # a set that only rows without an id have is a group by itself
    groups = rows.select("h1", "h2").distinct().join(by_class, ["h1", "h2"], "left")
    own = F.struct(F.col("component").isNull().alias("lone"), "component", *[F.when(F.col("component").isNull(), F.col(h)).alias(h) for h in ("h1", "h2")])
    groups = groups.select("h1", "h2", own.alias("group"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first")
    firsts = rows.groupBy("h1", "h2").agg(first).join(groups, ["h1", "h2"]).groupBy("group").agg(F.min("first").alias("first"))
    stay = scratch.save(firsts.select(F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash")), "stay")
    empty = scratch.save(sketches.where("n = 0").select("id", "text_hash").distinct(), "empty")
    names = _free(docs.columns, "key", "hash", "nth")
    hashed = docs.withColumn(names[1], F.xxhash64(text_col))

    def of(found: DataFrame, how: str) -> DataFrame:
        keys = found.select(F.col("id").alias(names[0]), F.col("text_hash").alias("__text_hash"))
        on = hashed[id_col].eqNullSafe(keys[names[0]]) & (hashed[names[1]] == keys["__text_hash"])
        return hashed.join(keys, on, how)

    copies = Window.partitionBy(id_col, names[1]).orderBy(names[1])
    one = of(stay, "left_semi").withColumn(names[2], F.row_number().over(copies)).where(F.col(names[2]) == 1)
    out = one.select(*docs.columns).unionByName(of(empty, "left_semi").select(*docs.columns))
    return out


def _free(taken: list[str], *names: str) -> list[str]:
    """``names`` with as many underscores before them as no column has."""
    lower = {c.lower() for c in taken}
    out = []
    for n in names:
        while (n := f"_{n}") in lower:
            pass
        out.append(n)
    return out
