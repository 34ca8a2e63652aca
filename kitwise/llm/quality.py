"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all
grades and ordered thresholds. Features are hashed into ``DIM`` places: words,
word shapes (runs of letter case, digits and signs), pairs of neighbouring
shapes, repeats of the word before, and the share of distinct words.

Training reads a bounded sample: the ``max_train`` labelled documents with the
smallest id hashes. Their features are made where the texts are and written;
one task then reads them (at most ``max_train`` documents, whatever the corpus)
and fits the model by L-BFGS. Scoring reads every text whole.

Edge cases: a null, empty or wordless text has no features and gets the grade
the thresholds alone give. Labels that are null count for nothing; an id with
several labels has its lowest one; labels without a document are unused.
Without any usable label every document is kept (tail probability 1). Rows
that repeat give repeated results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitwise.llm.scratch import Scratch
from kitwise.llm.words import Words, batches, mix, span_hashes

#: Hashed feature places (a power of two).
DIM = 1 << 18

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 97, 65, 48, 97


def _shapes(w: Words) -> np.ndarray:
    """A hash of each word's shape: its character classes without repeats."""
    kind = _CLASS[w.raw]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[w.start] = True
    before = np.concatenate((np.zeros(1, np.int64), np.cumsum(first)))
    return span_hashes(kind[first], before[w.start], before[w.end])


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, value) of all non-zero features of a batch, sorted by document and place.

    Values of each family are counts to the power 1/2, scaled to length 1 for a document.
    """
    w = Words(texts)
    shape = _shapes(w)
    pair_at = np.flatnonzero(w.doc[1:] == w.doc[:-1]) if len(w.doc) else np.zeros(0, np.int64)
    repeat = pair_at[w.hash[1:][pair_at] == w.hash[:-1][pair_at]] if len(pair_at) else pair_at
    families = [
        (w.doc, w.hash),
        (w.doc, mix(shape + np.uint64(1))),
        (w.doc[pair_at], mix(mix(shape[pair_at]) + shape[pair_at + 1] + np.uint64(2))),
    ]
    docs, places, values = [], [], []
    distinct = np.zeros(w.n_docs)
    for i, (doc, h) in enumerate(families):
        key = (doc.astype(np.uint64) * np.uint64(DIM)) | (mix(h + np.uint64(i)) & np.uint64(DIM - 1))
        key, count = np.unique(key, return_counts=True)
        d = (key // np.uint64(DIM)).astype(np.int64)
        value = np.sqrt(count)
        value = value / np.sqrt(np.bincount(d, count, w.n_docs))[d]
        if i == 0:
            distinct = np.bincount(d, minlength=w.n_docs)
        docs.append(d)
        places.append((key % np.uint64(DIM)).astype(np.int64))
        values.append(value)
    # shares in tenths: repeats of the word before, and distinct words
    n = np.maximum(w.counts, 1)
    full = np.flatnonzero(w.counts)
    for i, share in enumerate((np.bincount(w.doc[repeat], minlength=w.n_docs) / n, distinct / n)):
        docs.append(full)
        step = np.minimum(share[full] * 10, 10).astype(np.uint64)
        places.append((mix(step + np.uint64(1000 * (i + 1))) & np.uint64(DIM - 1)).astype(np.int64))
        values.append(np.ones(len(full)))
    doc, place, value = np.concatenate(docs), np.concatenate(places), np.concatenate(values)
    order = np.lexsort((place, doc))
    return doc[order], place[order], value[order]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def _unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds; each threshold is the one before plus an exponential."""
    head = p[DIM:]
    return p[:DIM], np.cumsum(np.concatenate((head[:1], np.exp(head[1:]))))


def _loss_and_gradient(p: np.ndarray, grade: np.ndarray, doc: np.ndarray, place: np.ndarray, value: np.ndarray, l2: float):
    """Of parameters p over (document, place, value) features: penalised loss, and its gradient."""
    w, cut = _unpack(p)
    s = np.bincount(doc, w[place] * value, len(grade))
    edge = np.concatenate(([-np.inf], cut, [np.inf]))
    upper, lower = edge[grade + 1] - s, edge[grade] - s
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    su, sl = np.where(np.isinf(upper), 1.0, sig(upper)), np.where(np.isinf(lower), 0.0, sig(lower))
    like = np.maximum(su - sl, 1e-12)
    du, dl = su * (1 - su) / like, sl * (1 - sl) / like  # slopes at the two edges
    grad_w = np.bincount(place, (du - dl)[doc] * value, DIM) + l2 * w
    grad_cut = np.array([dl[grade == k + 1].sum() - du[grade == k].sum() for k in range(len(cut))])
    later = np.cumsum(grad_cut[::-1])[::-1]  # a head moves its threshold and all after it
    grad = np.concatenate((grad_w, later[:1], later[1:] * np.exp(p[DIM + 1 :])))
    return -np.log(like).sum() + l2 / 2 * float(w @ w), grad


def _minimise(evaluate, p: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with backtracking."""
    f, g = evaluate(p)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, y in reversed(history):
            a = (s @ q) / (s @ y)
            alphas.append(a)
            q -= a * y
        q *= (history[-1][0] @ history[-1][1]) / (history[-1][1] @ history[-1][1]) if history else 1 / max(1.0, np.linalg.norm(g))
        for (s, y), a in zip(history, reversed(alphas), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        step = 1.0
        while True:
            x = p - step * q
            fx, gx = evaluate(x)
            if fx <= f - 1e-4 * step * (g @ q) or step < 1e-3:
                break
            step /= 4
        if fx >= f:
            break
        if (x - p) @ (gx - g) > 1e-10:
            history = [*history[-7:], (x - p, gx - g)]
        done = f - fx < 1e-4 * abs(f)
        p, f, g = x, fx, gx
        if done:
            break
    return p


def _fit(n_grades: int, l2: float, steps: int):
    """Of all rows (grade, places, values) of a sample: one row with the model."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grades, sizes, places, values = [], [], [], []
        for part in parts:
            grades.append(part.column(0).to_numpy())
            sizes.append(np.diff(part.column(1).offsets.to_numpy()))
            places.append(part.column(1).flatten().to_numpy())
            values.append(part.column(2).flatten().to_numpy())
        if not grades:
            return
        grade, place, value = np.concatenate(grades), np.concatenate(places), np.concatenate(values)
        doc = np.repeat(np.arange(len(grade), dtype=np.int32), np.concatenate(sizes))
        below = np.clip(np.cumsum(np.bincount(grade, minlength=n_grades))[:-1] / len(grade), 0.005, 0.995)
        cut = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-2 * np.arange(n_grades - 1))
        start = np.concatenate((np.zeros(DIM), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))))
        p = _minimise(lambda x: _loss_and_gradient(x, grade, doc, place, value, l2), start, steps)
        weights, cut = _unpack(p)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([cut.tobytes()])], names=["weights", "cut"])

    return run


def _feature_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts = part.column(1).to_pylist()
        for lo, hi in batches(texts):
            doc, place, value = features(texts[lo:hi])
            at = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32))),
                    pa.ListArray.from_arrays(at, pa.array(value)),
                ],
                names=["grade", "places", "values"],
            )


def _predict(model, id_type: pa.DataType):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for part in parts:
            texts = part.column(1).to_pylist()
            for lo, hi in batches(texts):
                doc, place, value = features(texts[lo:hi])
                tails = m.tails(np.bincount(doc, m.weights[place] * value, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).slice(lo, hi - lo).cast(id_type),
                        pa.array(tails.sum(1)),
                        pa.ListArray.from_arrays(
                            pa.array((np.arange(hi - lo + 1) * tails.shape[1]).astype(np.int32)), pa.array(tails.ravel())
                        ),
                    ],
                    names=["id", "expected_grade", "tails"],
                )

    return run


def train(
    docs: DataFrame,
    grades: DataFrame,
    n_grades: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_train: int = 20000,
    l2: float = 0.3,
    steps: int = 60,
) -> Model | None:
    """The model fitted on at most ``max_train`` documents of ``grades`` (id, grade); None without any."""
    scratch = Scratch(docs.sparkSession)
    usable = grades.where(F.col(id_col).isNotNull() & F.col("grade").between(0, n_grades - 1))
    usable = usable.groupBy(id_col).agg(F.min("grade").cast("int").alias("grade"))
    chosen = usable.orderBy(F.xxhash64(id_col), id_col).limit(max_train)  # a proven bound for the broadcast
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select("grade", text_col)
    schema = T.StructType(
        [
            T.StructField("grade", T.IntegerType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("values", T.ArrayType(T.DoubleType())),
        ]
    )
    sample = scratch.save(rows.mapInArrow(_feature_rows, schema), "sample")
    fitted = sample.coalesce(1).mapInArrow(_fit(n_grades, l2, steps), "weights binary, cut binary").collect()  # one row
    scratch.keep_only()
    return Model(np.frombuffer(fitted[0]["weights"]), np.frombuffer(fitted[0]["cut"])) if fitted else None


def grade(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", level: int | None = None
) -> DataFrame:
    """(id, expected_grade, tail_prob) of each row; tail_prob is P(grade >= level), by default of the highest grade."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(None).cast("double").alias("expected_grade"), F.lit(1.0).alias("tail_prob"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM weights, whatever the input
    kind = docs.schema[id_col].dataType
    id_type = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}[kind]
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("expected_grade", T.DoubleType()), T.StructField("tails", T.ArrayType(T.DoubleType()))]
    )
    out = rows.mapInArrow(_predict(shared, id_type), schema)
    at: Column = F.col("tails")[(level or len(model.thresholds)) - 1]
    return out.select(F.col("id").alias(id_col), "expected_grade", at.alias("tail_prob"))


def _select(model, text_at: int, least: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for part in parts:
            texts = part.column(text_at).to_pylist()
            for lo, hi in batches(texts):
                doc, place, value = features(texts[lo:hi])
                tail = m.tails(np.bincount(doc, m.weights[place] * value, hi - lo))[:, -1]
                yield part.slice(lo, hi - lo).filter(pa.array(tail >= least))

    return run


def select(docs: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, whole, whose chance of the highest grade is at least ``least``."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_select(shared, docs.columns.index(text_col), least), docs.schema)
