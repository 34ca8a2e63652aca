"""Exact ranked lexical search: branch and bound over document FP-trees.

The queries (items) are a table; their terms are the only ones that count. One
pass over the documents keeps each one's length and its vector of item terms
with their numbers of occurrences; document frequencies, the number of
documents and the length of all of them are summed over these vectors.

A term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))). A document of n
terms has m = 100 - 90 + (90 n N) div L, and scores the sum of
w * ((10**9 tf) div (1000 tf + 8 m)) over the item's distinct terms.

Every task builds FP-trees of some thousand documents of similar length: the
vectors, their terms in order of falling document frequency, are sorted, so
documents that begin with the same terms share a path, and a node is a run of
documents (nodes with one child are left out, nodes of at most ``LEAF``
documents are not divided). A node has, for every term below it, the largest
tf, and the least m; a term's gain grows with tf and falls with m, so the gains
of these two, weighted by the item, bound the score of all documents below.
Each item descends depth first into the child of the highest bound and leaves out
nodes whose bound is less than the k-th best score so far in the task. Of each
task at most k documents an item remain, and the best k of these are the result.

The items are taken in blocks of ``ITEM_CHARS`` characters, each a pass of its
own, so what is sent to the tasks is bounded whatever the number of items.

Edge cases: a null text has no terms, and a document without terms counts
neither in N nor in L. An item without terms has no result. Rows that repeat a
document id are separate documents; rows that repeat an item id are separate
items with ranks of their own. Equal scores are in order of id, null first. Scores
of 0 are left out. Empty tables give no rows. Only ids and texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitwise.llm.scratch import Scratch
from kitwise.llm.words import batches

#: Documents, and vector entries, of a tree at most; documents of a node that is not divided.
DOCS, ENTRIES, LEAF = 8192, 1 << 21, 16
#: Characters of the item texts of one pass.
ITEM_CHARS = 1 << 23
#: Parts of an item's candidates that are ranked before the last ranking.
PARTS = 16

#: Bytes of a term stay (A-Z as a-z); all others of ASCII part terms.
_TERM = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() and b < 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_TERM).split()


@dataclass
class Queries:
    """Items of one pass. ``places``: each item's distinct terms as numbers; ``vocabulary``: the number of each term."""

    ids: list
    places: list[np.ndarray]
    vocabulary: dict[bytes, int]


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = [list(dict.fromkeys(terms_of(t))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.binary()))], names=["id", "terms"])

    kind = T.StructType([T.StructField("id", items.schema[id_col].dataType), T.StructField("terms", T.ArrayType(T.BinaryType()))])
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(found, kind)
    block, size = Queries([], [], {}), 0
    for item, terms in rows.where(F.size("terms") > 0).toLocalIterator():
        block.ids.append(item)
        block.places.append(np.array([block.vocabulary.setdefault(bytes(t), len(block.vocabulary)) for t in terms], np.int64))
        size += sum(map(len, terms))
        if size >= ITEM_CHARS:
            yield block
            block, size = Queries([], [], {}), 0
    if block.ids:
        yield block


VECTOR = (("n", T.LongType()), ("terms", T.ArrayType(T.IntegerType())), ("tfs", T.ArrayType(T.IntegerType())))


def _vectors(vocabulary):
    """(id, n, terms, tfs) of each document that has terms; only terms of the vocabulary are in the vector."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for part in parts:
            texts = part.column(1).to_pylist()
            for lo, hi in batches(texts):
                lengths, numbers = [], []
                for text in texts[lo:hi]:
                    words = terms_of(text)
                    lengths.append(len(words))
                    numbers.extend(map(known.get, words, repeat(-1)))
                n = np.array(lengths, np.int64)
                doc, number = np.repeat(np.arange(hi - lo), n), np.array(numbers, np.int64)
                there = number >= 0
                key, tf = np.unique(doc[there] * len(known) + number[there], return_counts=True)
                cut = np.concatenate((np.zeros(1, np.int32), np.cumsum(np.bincount(key // len(known), minlength=hi - lo), dtype=np.int32)))
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(v.astype(np.int32))) for v in (key % len(known), tf)]
                out = pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), pa.array(n), *lists], names=["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return run


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indexes of the runs that begin at ``start`` and have ``size`` places."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class Tree:
    """The FP-tree of documents given by ids, lengths as m, vector sizes, and terms (as ranks) with tf."""

    def __init__(self, ids: list, m: np.ndarray, size: np.ndarray, rank: np.ndarray, tf: np.ndarray):
        first = np.cumsum(size) - size
        coded, cut = rank.astype(">u4").tobytes(), (4 * np.append(first, len(rank))).tolist()
        paths = [coded[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        order = np.array(sorted(range(len(ids)), key=paths.__getitem__), np.int64)
        entries = _runs(first[order], size[order])
        self.ids, m = [ids[i] for i in order.tolist()], m[order]
        self.rank, size = rank[entries], size[order]
        self.first = np.append(0, np.cumsum(size))
        owner = np.repeat(np.arange(len(order)), size)
        tf = tf[entries]
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        self._nodes([paths[i] for i in order.tolist()])
        self._bounds(tf, m)

    def _nodes(self, paths: list[bytes]) -> None:
        """Runs of documents, breadth first, so that a node's children are neighbours."""
        lo, hi, children = [0], [len(paths)], []
        at = 0
        while at < len(lo):
            a, b = lo[at], hi[at]
            shared = _common(paths[a], paths[b - 1])  # of sorted paths, the first and the last share the least
            begin = len(lo)
            if b - a > LEAF and shared < len(paths[b - 1]):
                heads = [p[shared : shared + 4] for p in paths[a:b]]
                cuts = [a, *[a + i for i in range(1, b - a) if heads[i] != heads[i - 1]], b]
                lo += cuts[:-1]
                hi += cuts[1:]
            children.append((begin, len(lo)))
            at += 1
        self.lo, self.hi, self.children = lo, hi, children

    def _bounds(self, tf: np.ndarray, m: np.ndarray) -> None:
        """For every node its terms and their bounds: the gain of the largest tf at the least m."""
        own: list = [None] * len(self.lo)
        for at in range(len(self.lo) - 1, -1, -1):
            begin, end = self.children[at]
            if begin == end:
                span = slice(self.first[self.lo[at]], self.first[self.hi[at]])
                rank, largest = self.rank[span], tf[span]
            else:
                rank, largest = (np.concatenate([own[c][k] for c in range(begin, end)]) for k in range(2))
            order = np.argsort(rank, kind="stable")
            rank, largest = rank[order], largest[order]
            new = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
            own[at] = rank[new], np.maximum.reduceat(largest, new)
        sizes = np.array([len(o[0]) for o in own])
        self.node_first = np.append(0, np.cumsum(sizes))
        self.node_rank = np.concatenate([o[0] for o in own])
        largest = np.concatenate([o[1] for o in own])
        least = np.array([m[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)])
        self.node_gain = (1_000_000_000 * largest) // (1000 * largest + 8 * np.repeat(least, sizes))

    def search(self, weight: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """``best`` (-score, id key, id) with this tree's documents; ``weight`` by rank, 0 for terms of other items."""
        todo = [(None, 0)]
        while todo:
            bound, node = todo.pop()
            if bound is not None and (bound <= 0 or (len(best) == k and bound < -best[-1][0])):
                continue
            begin, end = self.children[node]
            if begin < end:
                cut = self.node_first[begin : end + 1]
                gains = weight[self.node_rank[cut[0] : cut[-1]]] * self.node_gain[cut[0] : cut[-1]]
                bounds = np.add.reduceat(gains, cut[:-1] - cut[0])
                for i in np.argsort(bounds, kind="stable").tolist():  # the highest is on top
                    todo.append((int(bounds[i]), begin + i))
                continue
            lo, hi = self.lo[node], self.hi[node]
            cut = self.first[lo : hi + 1]
            scores = np.add.reduceat(weight[self.rank[cut[0] : cut[-1]]] * self.gain[cut[0] : cut[-1]], cut[:-1] - cut[0])
            least = -best[-1][0] if len(best) == k else 1
            found = np.flatnonzero(scores >= least)
            if len(found):
                new = [(-int(scores[i]), (self.ids[lo + i] is not None, self.ids[lo + i])) for i in found.tolist()]
                if len(best) + len(new) > k:
                    new = sorted(new)[:k]
                best = sorted([*best, *new])[:k]
        return best


def _common(a: bytes, b: bytes) -> int:
    """The length of what two paths share, in whole terms."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, ">u4", n // 4), np.frombuffer(b, ">u4", n // 4)
    other = np.flatnonzero(x != y)
    return 4 * int(other[0]) if len(other) else n


def _ranked(pass_data, n_docs: int, all_terms: int, k: int, id_type: pa.DataType, item_type: pa.DataType):
    """(item, item_id, doc_id, score): each task's best ``k`` documents of each item."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, order, weights = pass_data.value
        weight = np.zeros(len(order), np.int64)
        best: list[list[tuple]] = [[] for _ in queries.ids]

        def use(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            size = np.asarray(pa.compute.list_value_length(rows["terms"]), np.int64)
            rank, tf = (rows[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
            rank = order[rank]
            sort = np.lexsort((rank, np.repeat(np.arange(len(size)), size)))
            m = 10 + (90 * rows["n"].to_numpy() * n_docs) // all_terms
            tree = Tree(rows["id"].to_pylist(), m, size, rank[sort], tf[sort])
            for item, places in enumerate(queries.places):
                ranks = order[places]
                weight[ranks] = weights[places]
                best[item] = tree.search(weight, best[item], k)
                weight[ranks] = 0

        held, docs, entries = [], 0, 0
        for part in parts:
            while part.num_rows:
                sizes = np.cumsum(np.asarray(pa.compute.list_value_length(part.column(2)), np.int64))
                take = max(1, min(DOCS - docs, int(np.searchsorted(sizes, ENTRIES - entries, side="right")))) if docs < DOCS else 0
                if docs and (take == 0 or entries >= ENTRIES):
                    use(held)
                    held, docs, entries = [], 0, 0
                    continue
                held.append(part.slice(0, take))
                docs, entries, part = docs + min(take, part.num_rows), entries + int(sizes[min(take, part.num_rows) - 1]), part.slice(take)
        if held:
            use(held)
        rows = [(i, queries.ids[i], key[1] if key[0] else None, -score) for i, own in enumerate(best) for score, key in own]
        if rows:
            item, item_id, doc, score = zip(*rows, strict=True)
            columns = [pa.array(item, pa.int64()), pa.array(item_id, item_type), pa.array(doc, id_type), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "doc_id", "score"])

    return run


def _one_pass(docs: DataFrame, queries: Queries, scratch: Scratch, name: str, k: int, item_field: T.StructField) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    sc = docs.sparkSession.sparkContext
    id_field = docs.schema["id"]
    kind = T.StructType([T.StructField("id", id_field.dataType), *[T.StructField(n, t) for n, t in VECTOR]])
    vectors = scratch.save(docs.mapInArrow(_vectors(sc.broadcast(queries.vocabulary)), kind), f"vectors-{name}")
    n_docs, all_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(len(queries.vocabulary), np.int64)
    for term, df in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the pass
        frequency[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
    order = np.empty(len(frequency), np.int64)
    order[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency))
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", item_field.dataType),
        T.StructField("doc_id", id_field.dataType), T.StructField("score", T.LongType()),
    ])
    data = sc.broadcast((queries, order, weights))
    run = _ranked(data, int(n_docs), max(int(all_terms), 1), k, to_arrow_type(id_field.dataType), to_arrow_type(item_field.dataType))
    found = vectors.where(F.size("terms") > 0).sortWithinPartitions("n").mapInArrow(run, schema)
    # an item's candidates are at most k a task; most go before its last ranking
    ahead = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    found = found.withColumn("rank", ahead("item", "part")).where(F.col("rank") <= k)
    found = found.withColumn("rank", ahead("item")).where(F.col("rank") <= k)
    out = scratch.save(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), f"ranked-{name}")
    scratch.drop(f"vectors-{name}")
    return out


def rank(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    field = items.schema[item_id_col]
    passes = [
        _one_pass(rows, block, scratch, str(i), k, field) for i, block in enumerate(_blocks(items, item_id_col, item_text_col))
    ]
    if not passes:
        none = T.StructType([
            T.StructField("item_id", field.dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
        ])
        return docs.sparkSession.createDataFrame([], none)
    return reduce(DataFrame.unionAll, passes)
