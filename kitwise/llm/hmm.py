"""Hidden Markov language model: distributed Baum-Welch and exact forward scores.

Tokens are the words of a text, A-Z lower-cased, and one end token. The model
has ``states`` latent states over a bounded alphabet of symbols: the words that
make up at least 1 / ``head`` of all training tokens (at most ``head`` words can),
``TAIL_CLASSES`` classes of all other words (by their last bytes and length),
and the end. A word w of a class has probability P(class | state) *
(c(w) + 0.1) / (C + 0.1 * (V + 1)), with C tokens and V distinct words in its
class, the last place for words never seen.

1. Word counts over all training texts (a shuffle that grows with the corpus).
2. Baum-Welch: expected counts of transitions and symbols are computed where the
   texts are and summed by symbol in Spark. Every round reads every training text
   whole (worked on in segments of ``SEGMENT`` tokens, with the forward and
   backward weights carried over their borders). Rounds end when the summed
   log-likelihood gains less than ``least_gain`` of itself, or after ``rounds``.
3. Scores: the scaled forward recursion over the whole token sequence of each
   text; the sum of the logarithms of the scales is the exact log-likelihood of
   the symbols. Counts of frequent words travel as one bounded table (words
   with at least 1 / ``common`` of all tokens); rarer words of a text join the full
   count table, so no vocabulary is ever held whole.

The base score is the unigram sum of log10((c + 0.1) / (N + 0.1 * (V + 1))).

Edge cases: a null or empty text is its end token alone. Documents held out
take no part in any count. Rows that repeat are counted and scored each; a null
id has the checksum of the empty string. Without training tokens every word
has probability 1 in the base, and the model is uniform over its symbols. Words
are stood for by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitwise.llm.scratch import Scratch
from kitwise.llm.words import Words, batches, mix, span_hashes

TAIL_CLASSES = 2048
SEGMENT = 128


@dataclass
class Alphabet:
    """Which symbol a word is: the sorted hashes of the head words, then tail classes, then the end."""

    head: np.ndarray

    @property
    def size(self) -> int:
        return len(self.head) + TAIL_CLASSES + 1

    @property
    def end(self) -> int:
        return len(self.head) + TAIL_CLASSES

    @property
    def code(self) -> type:
        return np.int16 if self.size < 1 << 15 else np.int32

    def symbols(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, whether it is a head word) of each word."""
        at = _find(self.head, w.hash)
        return np.where(at >= 0, at, len(self.head) + tail_class(w)), at >= 0


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol x state


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places in a sorted table, -1 where a value is missing."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


class Lookup:
    """Places in a sorted table of hashes, found from where their first bits begin."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.shift = np.uint64(64 - max(1, len(table).bit_length()))
        self.start = np.searchsorted(table >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))

    def find(self, values: np.ndarray) -> np.ndarray:
        """As ``_find``."""
        out = np.full(len(values), -1)
        first = (values >> self.shift).astype(np.int64)
        at, end = self.start[first], self.start[first + 1]
        left = np.flatnonzero(at < end)
        at, end, wanted = at[left], end[left], values[left]
        while len(left):
            here = self.table[at]
            same = here == wanted
            out[left[same]] = at[same]
            on = np.flatnonzero((here < wanted) & (at + 1 < end))
            left, at, end, wanted = left[on], at[on] + 1, end[on], wanted[on]
        return out


def tail_class(w: Words) -> np.ndarray:
    """A word's class: its last three bytes and its length up to 15."""
    ending = span_hashes(w.bytes, np.maximum(w.start, w.end - 3), w.end)
    length = np.minimum(w.end - w.start, 15).astype(np.uint64)
    return (mix(ending * np.uint64(31) + length) % np.uint64(TAIL_CLASSES)).astype(np.int64)


def _sequences(w: Words, symbols: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All token sequences one after another, each with its end, and their lengths."""
    size = w.counts + 1
    out = np.full(size.sum(), end, np.int64)
    last = np.cumsum(size) - 1
    words = np.ones(len(out), bool)
    words[last] = False
    out[words] = symbols
    return out, size


def forward(seq: np.ndarray, size: np.ndarray, m: Hmm) -> np.ndarray:
    """Natural log-likelihood of each sequence by the scaled forward recursion, all sequences a step at a time."""
    order = np.argsort(-size, kind="stable")
    first = (np.cumsum(size) - size)[order]
    left = size[order]
    active = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
    like, ones = np.zeros(len(size)), np.ones(len(m.start))
    a = np.zeros((0, len(m.start)))
    for t, n in enumerate(active):
        a = a[:n] @ m.move if t else np.tile(m.start, (n, 1))
        a *= m.emit.take(seq.take(first[:n] + t), axis=0)
        scale = a @ ones
        a /= scale[:, None]
        like[:n] += np.log(scale)
    out = np.empty(len(size))
    out[order] = like
    return out


def _transfers(seq: np.ndarray, begin: np.ndarray, length: np.ndarray, m: Hmm) -> np.ndarray:
    """For each segment the weights of its last state given its first, up to a factor a segment."""
    s = len(m.start)
    move = m.move.astype(np.float32)
    emit = (m.emit / m.emit.max(1, keepdims=True)).astype(np.float32)
    out, ones = np.zeros((len(begin), s, s), np.float32), np.ones(s * s, np.float32)
    order = np.argsort(-length, kind="stable")
    for lo in range(0, len(begin), 1024):
        own = order[lo : lo + 1024]
        b, n_left = begin[own], length[own]
        a = np.eye(s, dtype=np.float32) * emit[seq[b]][:, None]
        for t in range(1, int(n_left[0])):
            n = np.searchsorted(-n_left, -t)
            step = (a[:n].reshape(-1, s) @ move).reshape(n, s * s)
            step *= np.tile(emit.take(seq.take(b[:n] + t), axis=0), s)
            if t % 4 == 0:
                step /= (step @ ones)[:, None]
            a[:n] = step.reshape(n, s, s)
        out[own] = a / a.max((1, 2), keepdims=True)
    return out


def expected_counts(seq: np.ndarray, size: np.ndarray, m: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch counts of starts, moves and (symbol, state), and the log-likelihood, of whole sequences.

    A sequence is worked on in segments side by side. What reaches a segment
    from both sides is carried over the borders by the segments' transfers.
    """
    s = len(m.start)
    starts, moves, emits = np.zeros(s), np.zeros((s, s)), np.zeros((len(m.emit), s))
    pieces = -(-size // SEGMENT)
    first = np.cumsum(pieces) - pieces
    text = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(text)) - first[text]
    begin = (np.cumsum(size) - size)[text] + nth * SEGMENT
    length = np.minimum(size[text] - nth * SEGMENT, SEGMENT)
    # forward weights of the first state and of the state before it, backward weights of the last state
    prior, before, behind = np.tile(m.start, (len(text), 1)), np.zeros((len(text), s)), np.ones((len(text), s))
    long = np.flatnonzero(pieces > 1)
    long = long[np.argsort(-pieces[long], kind="stable")]
    if len(long):
        inner = np.flatnonzero(pieces[text] > 1)
        through = np.zeros((len(text), s, s), np.float32)
        through[inner] = _transfers(seq, begin[inner], length[inner], m)
        for k in range(1, int(pieces[long[0]])):
            at = first[long[pieces[long] > k]] + k
            out = np.einsum("ni,nij->nj", prior[at - 1], through[at - 1])
            before[at] = out / out.sum(1, keepdims=True)
            prior[at] = before[at] @ m.move
        for k in range(int(pieces[long[0]]) - 1, 0, -1):
            at = first[long[pieces[long] > k]] + k
            back = np.einsum("nij,nj->ni", through[at], behind[at]) @ m.move.T
            behind[at - 1] = back / back.sum(1, keepdims=True)
    order = np.argsort(-length, kind="stable")
    begin, length, opening = begin[order], length[order], (nth == 0)[order]
    prior, before, behind = prior[order].astype(np.float32), before[order].astype(np.float32), behind[order].astype(np.float32)
    move, emission, ones = m.move.astype(np.float32), m.emit.astype(np.float32), np.ones(s, np.float32)
    like = 0.0
    for lo in range(0, len(begin), 1024):
        own = slice(lo, lo + 1024)
        b, n_left, opens = begin[own], length[own], opening[own]
        steps = int(n_left[0])
        active = np.searchsorted(-n_left, -np.arange(1, steps + 1), side="right")
        alpha = np.zeros((steps, len(b), s), np.float32)
        emit = np.zeros((steps, len(b), s), np.float32)
        scale = np.ones((steps, len(b)), np.float32)
        for t in range(steps):
            n = active[t]
            emit[t, :n] = emission.take(seq.take(b[:n] + t), axis=0)
            a = alpha[t - 1, :n] @ move if t else prior[own].copy()
            a *= emit[t, :n]
            scale[t, :n] = a @ ones
            np.divide(a, scale[t, :n, None], out=alpha[t, :n])
        like += float(np.log(scale.astype(np.float64)).sum())
        beta = behind[own]
        beta = beta / (alpha[n_left - 1, np.arange(len(b))] * beta).sum(1, keepdims=True)
        gamma = np.zeros((steps, len(b), s), np.float32)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            np.multiply(alpha[t, :n], beta[:n], out=gamma[t, :n])
            after = emit[t, :n]  # not read again
            after *= beta[:n]
            after /= scale[t, :n, None]
            moves += move * ((alpha[t - 1, :n] if t else before[own]).T @ after)
            if t:
                np.matmul(after, move.T, out=beta[:n])
        starts += gamma[0, opens].sum(0)
        live = np.arange(steps)[:, None] < n_left[None]
        where = seq[(b[None] + np.arange(steps)[:, None])[live]]
        g = gamma[live]
        for k in range(s):
            emits[:, k] += np.bincount(where, g[:, k], len(emits))
    return starts, moves, emits, like


def _word_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        texts = part.column(0).to_pylist()
        for lo, hi in batches(texts, 1 << 22):
            w = Words(texts[lo:hi])
            value, at, count = np.unique(w.hash, return_index=True, return_counts=True)
            kind = tail_class(w)[at] if len(at) else np.zeros(0, np.int64)
            # the end tokens: one a text
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(value.view(np.int64), 0)),
                    pa.array(np.append(kind, -1).astype(np.int32)),
                    pa.array(np.append(count, hi - lo).astype(np.int64)),
                ],
                names=["word", "kind", "c"],
            )


def _symbols(alphabet):
    """Each text as the bytes of its symbols, so that the rounds need not read words again."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = alphabet.value
        for part in parts:
            texts = part.column(0).to_pylist()
            for lo, hi in batches(texts):
                w = Words(texts[lo:hi])
                seq, size = _sequences(w, al.symbols(w)[0], al.end)
                data = seq.astype(al.code)
                cut = np.append(0, np.cumsum(size) * data.itemsize).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(cut), pa.py_buffer(data)])], names=["seq"])

    return run


def _expectation(alphabet, model):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, m = alphabet.value, model.value
        s = len(m.start)
        starts, moves, emits, like = np.zeros(s), np.zeros((s, s)), np.zeros((al.size, s)), 0.0
        for part in parts:
            coded = part.column(0).to_pylist()
            for lo, hi in batches(coded, 1 << 19):
                size = np.array([len(x) for x in coded[lo:hi]], np.int64) // np.dtype(al.code).itemsize
                seq = np.frombuffer(b"".join(coded[lo:hi]), al.code)
                a, b, c, d = expected_counts(seq, size, m)
                starts, moves, emits, like = starts + a, moves + b, emits + c, like + d
        # rows: the likelihood, the starts, one for each state's moves, one for each symbol seen
        seen = np.flatnonzero(emits.sum(1))
        table = np.concatenate((np.full((1, s), like), starts[None], moves, emits[seen]))
        place = np.concatenate((np.arange(-2 - s, 0), seen))
        yield pa.RecordBatch.from_arrays([pa.array(place), *[pa.array(table[:, k]) for k in range(s)]], names=["place", *[f"s{k}" for k in range(s)]])

    return run


def _scoring(alphabet, model, tables):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, m, t = alphabet.value, model.value, tables.value
        frequent = Lookup(t["word"])
        row = TaskContext.get().partitionId() << 33
        for part in parts:
            texts = part.column(1).to_pylist()
            # long batches: each has as many forward steps as its longest text has tokens
            for lo, hi in batches(texts, 1 << 22):
                w = Words(texts[lo:hi])
                n = hi - lo
                symbol, is_head = al.symbols(w)
                seq, size = _sequences(w, symbol, al.end)
                at = frequent.find(w.hash)
                common = at >= 0
                log_c = np.where(common, t["log_c"][np.maximum(at, 0)] if len(t["word"]) else 0.0, 0.0)
                within = np.where(is_head, 0.0, -t["log_class"][np.where(is_head, 0, symbol - len(al.head))])
                inside = np.where(is_head, 0.0, log_c) + within  # what a tail word has within its class, as far as known here
                base = np.bincount(w.doc, log_c, n) + t["log_end"] - size * t["log_all"]
                score = forward(seq, size, m) / np.log(10) + np.bincount(w.doc, inside, n)
                # the other words of each text, counted
                rare = np.flatnonzero(~common)
                order = rare[np.lexsort((w.hash[rare], w.doc[rare]))]
                doc, value = w.doc[order], w.hash[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(doc)))
                cut = np.searchsorted(doc[start], np.arange(n + 1)).astype(np.int32)
                list_of = lambda x: pa.ListArray.from_arrays(pa.array(cut), pa.array(x))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        part.column(0).slice(lo, n),
                        pa.array(size),
                        pa.array(np.bincount(w.doc, common, n).astype(np.int64) + t["end_known"]),
                        pa.array(base),
                        pa.array(score),
                        list_of(value[start].view(np.int64)),
                        list_of(times.astype(np.int32)),
                    ],
                    names=["row", "id", "n_tokens", "n_known", "base", "score", "words", "times"],
                )
                row += n

    return run


def held_out(id_col: str, parts: int = 10) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text, remainder 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == 0


def _start_model(size: int, states: int, share: np.ndarray, seed: int) -> Hmm:
    rng = np.random.default_rng(seed)
    emit = share[:, None] * rng.lognormal(0.0, 1.0, (size, states))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), move, emit / emit.sum(0))


def _maximised(rows: list, states: int, share: np.ndarray) -> Hmm:
    """The next model; every count has a little of the unigram model added, so that nothing is impossible."""
    emits, special = np.zeros((len(share), states)), np.zeros((states + 2, states))
    for r in rows:
        values = [r[f"s{k}"] for k in range(states)]
        if r["place"] >= 0:
            emits[r["place"]] = values
        else:
            special[r["place"] + 2 + states] = values
    starts, moves = special[1] + 1, special[2:] + 1
    emits = emits + 10 * share[:, None]
    return Hmm(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = 8,
    head: int = 1 << 14,
    common: int = 1 << 21,
    rounds: int = 14,
    least_gain: float = 1e-3,
    seed: int = 5,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    scratch = Scratch(spark)
    train = docs.where(~held_out(id_col))

    counts = train.select(text_col).mapInArrow(_word_counts, "word long, kind int, c long")
    counts = counts.groupBy("word", "kind").agg(F.sum("c").alias("c"))
    counts = scratch.save(counts, "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = counts.where("kind < 0").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    words = counts.where("kind >= 0")

    # at most `common` words can have 1 / common of all tokens
    frequent = words.where(F.col("c") * common >= n).select("word", "kind", "c").toPandas()
    value = frequent["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    value, c = value[order], frequent["c"].to_numpy(np.int64)[order]
    in_head = c * head >= n
    alphabet = Alphabet(value[in_head])
    tail = words.where(F.col("c") * head < n).groupBy("kind").agg(F.sum("c").alias("c"), F.count("*").alias("v")).toPandas()
    class_c, class_v = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    class_c[tail["kind"].to_numpy(int)], class_v[tail["kind"].to_numpy(int)] = tail["c"], tail["v"]
    share = np.concatenate((c[in_head], class_c, [ends])) + 0.1
    share = share / share.sum()

    shared_alphabet = sc.broadcast(alphabet)
    model = _start_model(alphabet.size, states, share, seed)
    coded = scratch.save(train.select(text_col).mapInArrow(_symbols(shared_alphabet), "seq binary"), "coded")
    schema = "place long, " + ", ".join(f"s{k} double" for k in range(states))
    like = -np.inf
    for _ in range(rounds if n else 0):
        shared = sc.broadcast(model)
        rows = coded.mapInArrow(_expectation(shared_alphabet, shared), schema)
        rows = rows.groupBy("place").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).collect()  # one row a symbol
        model = _maximised(rows, states, share)
        shared.unpersist()
        before, like = like, next(r["s0"] for r in rows if r["place"] == -2 - states)
        if like - before < least_gain * abs(like):
            break

    tables = {
        "word": value,
        "log_c": np.log10(c + 0.1),
        "log_class": np.log10(class_c + 0.1 * (class_v + 1)),
        "log_end": float(np.log10(ends + 0.1)),
        "log_all": float(np.log10(n + 0.1 * (v + 1))),
        "end_known": int(ends > 0),
    }
    kind = docs.schema[id_col].dataType
    out_type = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("id", kind),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("base", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("words", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )
    run = _scoring(shared_alphabet, sc.broadcast(model), sc.broadcast(tables))
    scored = scratch.save(docs.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, out_type), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    seen = words.where(F.col("c") * common < n).select("word", "c")
    # words without a count give log10(0.1) a time; those with one are set right by the join
    found = rare.join(seen, "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * (F.log10(F.col("c") + 0.1) + 1.0)).alias("gain")
    )
    times = F.aggregate("times", F.lit(0).cast("long"), lambda a, b: a + b)
    gain = F.coalesce("gain", F.lit(0.0)) - times
    out = scored.drop("words").join(found, "row", "left").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
    )
    out = scratch.save(out, "result")
    scratch.keep_only("result")
    return out
