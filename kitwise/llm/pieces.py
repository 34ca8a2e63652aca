"""SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed and its parts are rebuilt: the
normaliser (character map, extra white space, the leading space), the
metaspace marker that stands for a space, the pieces with their scores, user
defined pieces and byte fallback. Unigram models keep their scores; of BPE
models each piece that is two others put together is a merge, best score first.

Two neighbouring characters that stand together in no piece are never merged, so
a text can be cut between them and its pieces are those of its units put
together. Which pairs these are is read off the vocabulary (a space after
another character is one in models whose marker begins pieces). It takes a BPE
model with byte fallback whose normaliser leaves the text as it is but for the
marker; other models encode whole texts. Each worker encodes a unit once and
keeps its ids in a bounded table, found again by a 64-bit hash and the length.

Units (or texts) are encoded in batches on ``threads`` threads. Every new unit's
ids are decoded again and compared (``decodes``), and compared with those of
the sentencepiece library (``same``); a text has what all of its units have.

Edge cases: a null text has null ids; an empty text has none. A text that
holds the marker character itself is decoded with spaces in its place, as the
model can't tell them apart. Rows that repeat give repeated results. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitwise.llm.words import batches, span_hashes

MARK = "▁"
#: Kinds of piece in the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters of a batch, about.
BATCH = 1 << 20
#: Units that a worker keeps.
KEPT = 1 << 18


@dataclass
class Model:
    """What the model file says."""

    pieces: list[tuple[str, float, int]]
    is_unigram: bool
    unk_id: int
    byte_fallback: bool
    char_map: bytes
    leading_space: bool
    squeeze_spaces: bool

    def joins(self) -> np.ndarray:
        """[a, b]: whether some piece may hold byte b after byte a (the marker counts as a space).

        Bytes of longer characters may stand after any other, but a space
        after them is looked up as well.
        """
        out = np.zeros((256, 256), bool)
        out[128:, :] = out[:, 128:] = True
        out[128:, 32] = False
        for p, _, kind in self.pieces:
            if kind == NORMAL:
                b = np.frombuffer(p.replace(MARK, " ").encode(), np.uint8)
                out[b[:-1], b[1:]] = True
        return out


def parse(data: bytes) -> Model:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(data)
    t, n = proto.trainer_spec, proto.normalizer_spec
    if t.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models")
    if t.treat_whitespace_as_suffix or not n.escape_whitespaces:
        raise ValueError("only models that mark the space before a word")
    return Model(
        [(p.piece, p.score, p.type) for p in proto.pieces],
        t.model_type == 1,
        t.unk_id,
        t.byte_fallback,
        n.precompiled_charsmap,
        n.add_dummy_prefix,
        n.remove_extra_whitespaces,
    )


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, by falling score of the joined piece."""
    rank = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    out = []
    for p, score, kind in model.pieces:
        if kind in (NORMAL, USER):
            cuts = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in rank and p[i:] in rank]
            out += [(-score, rank[p], rank[a], rank[b], a, b) for a, b in cuts]
    out.sort(key=lambda m: m[:4])
    return [m[4:] for m in out]


def normaliser(model: Model):
    from tokenizers import Regex, normalizers

    steps = []
    if model.char_map:
        steps.append(normalizers.Precompiled(model.char_map))
    if model.squeeze_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if model.leading_space:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    return normalizers.Sequence(steps)


def bare_normaliser():
    """For units, which have their leading space already."""
    from tokenizers import normalizers

    return normalizers.Replace(" ", MARK)


def rebuild(model: Model):
    """The tokenizer of a model."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    if model.is_unigram:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges(model),
            unk_token=model.pieces[model.unk_id][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tok = Tokenizer(core)
    tok.normalizer = normaliser(model)
    user = [AddedToken(p, normalized=False, special=False) for p, _, kind in model.pieces if kind == USER]
    if user:
        tok.add_tokens(user)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.leading_space:
        steps.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(steps)
    return tok


class _Table:
    """Ids of units: places in ``flat``, checks and uses by entry, and a sorted index of their hashes."""

    def __init__(self):
        self.sorted_hash, self.sorted_entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.hash, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.good, self.used = np.zeros((0, 2), bool), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def find(self, hash_: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The entry of each unit, -1 where there is none."""
        if not len(self.hash):
            return np.full(len(hash_), -1)
        at = np.minimum(np.searchsorted(self.sorted_hash, hash_), len(self.hash) - 1)
        entry = self.sorted_entry[at]
        return np.where((self.sorted_hash[at] == hash_) & (self.length[entry] == length), entry, -1)

    def add(self, hash_: np.ndarray, length: np.ndarray, ids: list[list[int]], good: np.ndarray) -> None:
        """New entries; ``hash_`` is sorted."""
        size = np.array([len(i) for i in ids], np.int64)
        entry = np.arange(len(self.hash), len(self.hash) + len(ids))
        at = np.searchsorted(self.sorted_hash, hash_)
        self.sorted_hash, self.sorted_entry = np.insert(self.sorted_hash, at, hash_), np.insert(self.sorted_entry, at, entry)
        first = len(self.flat) + np.cumsum(size) - size
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        self.flat = np.concatenate((self.flat, flat))
        new = {"hash": hash_, "length": length, "first": first, "size": size, "good": good, "used": np.zeros(len(ids), np.int64)}
        for name, value in new.items():
            setattr(self, name, np.concatenate((getattr(self, name), value)))

    def shrink(self) -> None:
        """Forget the units used less than twice since the last time."""
        kept = np.flatnonzero(self.used > 1)
        self.flat = self.ids(kept)
        for name in ("hash", "length", "size", "good", "used"):
            setattr(self, name, getattr(self, name)[kept])
        self.first, self.used = np.cumsum(self.size) - self.size, np.zeros(len(kept), np.int64)
        self.sorted_entry = np.argsort(self.hash, kind="stable")
        self.sorted_hash = self.hash[self.sorted_entry]

    def ids(self, entry: np.ndarray) -> np.ndarray:
        size = self.size[entry]
        return self.flat[np.arange(size.sum()) + np.repeat(self.first[entry] - (np.cumsum(size) - size), size)]


class Pieces:
    """Encoder and decoder of one model file. ``parity``: compare with the sentencepiece library."""

    def __init__(self, data: bytes, parity: bool = False):
        self.model = m = parse(data)
        self.tokenizer = rebuild(m)
        self.by_unit = (
            not m.is_unigram and m.byte_fallback and m.leading_space and not m.squeeze_spaces and not m.char_map
            and not any(kind == USER for _, _, kind in m.pieces)
        )
        if self.by_unit:
            self.cut = ~m.joins()
            self.bare = rebuild(m)
            self.bare.normalizer = bare_normaliser()
        self.library = library(data, self.by_unit) if parity else None
        self.table = _Table()

    def whole(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray]:
        """Ids of each text, and whether they decode to it and whether the library gives the same."""
        wanted = texts if self.by_unit else [self.normalised(t) for t in texts]
        coder = self.bare if self.by_unit else self.tokenizer
        ids = [e.ids for e in coder.encode_batch_fast(texts, add_special_tokens=False)]
        ids = [i if t else [] for i, t in zip(ids, texts, strict=True)]
        good = np.ones((len(texts), 2), bool)
        if self.by_unit:  # the decoder leaves out one leading space
            wanted = [t.removeprefix(" ") for t in texts]
        good[:, 0] = [d == t for d, t in zip(self.decode(ids), wanted, strict=True)]
        if self.library is not None:
            other = self.library.encode(texts, num_threads=1)
            good[:, 1] = [a == b for a, b in zip(other, ids, strict=True)]
        return ids, good

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids one text after another, the number of each text's ids, and the two checks of each text."""
        if not self.by_unit:
            ids, good = self.whole(texts)
            size = np.array([len(i) for i in ids], np.int64)
            return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size, good
        coded = [(" " + t.replace(MARK, " ")).encode("utf-8") if t else b"" for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        joined = b"".join(coded)
        data = np.frombuffer(joined, np.uint8)
        begins = np.ones(len(data), bool)
        begins[1:] = self.cut[data[:-1], data[1:]]
        begins[(np.cumsum(size) - size)[size > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        hash_, length = span_hashes(data, start, end), end - start
        table = self.table
        if len(table.hash) > KEPT:
            table.shrink()
        at = table.find(hash_, length)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            _, once, which = np.unique(hash_[missing], return_index=True, return_inverse=True)
            at[missing] = len(table.hash) + which
            new = missing[once]
            ids, good = self.whole([joined[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            table.add(hash_[new], length[new], ids, good)
        table.used += np.bincount(at, minlength=len(table.hash))
        text = np.searchsorted(np.cumsum(size), start, side="right")
        n = len(texts)
        good = np.stack([np.bincount(text, ~table.good[at, k], n) == 0 for k in range(2)], axis=1)
        return table.ids(at), np.bincount(text, table.size[at], n).astype(np.int64), good

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def normalised(self, text: str) -> str:
        """What decoding must give back."""
        plain = self.tokenizer.normalizer.normalize_str(text).replace(MARK, " ") if text else ""
        return plain[1:] if self.model.leading_space and plain.startswith(" ") else plain


def library(data: bytes, bare: bool):
    """The sentencepiece library's own processor; ``bare``: without the leading space."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    if bare:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        proto.normalizer_spec.add_dummy_prefix = False
        data = proto.SerializeToString()
    return sentencepiece.SentencePieceProcessor(model_proto=data)


@lru_cache(maxsize=2)
def _loaded(data: bytes, parity: bool = False) -> Pieces:
    return Pieces(data, parity)


def _threads(n: int) -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if n > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(n)


def _encode(data, threads: int, check_decoding: bool, parity: bool):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        model = _loaded(data.value, parity)
        for part in parts:
            texts = part.column(1).to_pylist()
            for lo, hi in batches(texts, BATCH):
                ids, size, good = model.encode([t or "" for t in texts[lo:hi]])
                cut = np.concatenate((np.zeros(1, np.int32), np.cumsum(size, dtype=np.int32)))
                null = np.array([t is None for t in texts[lo:hi]])
                columns = [
                    part.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(cut), pa.array(ids), mask=pa.array(null)),
                    pa.array(size),
                    *[pa.array(good[:, k]) for k, wanted in enumerate((check_decoding, parity)) if wanted],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_names(check_decoding, parity))

    return run


def _names(check_decoding: bool, parity: bool) -> list[str]:
    return ["id", "ids", "n_tokens", *["decodes"] * check_decoding, *["same"] * parity]


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    threads: int = 2,
    check_decoding: bool = True,
    parity: bool = False,
) -> DataFrame:
    """(id, ids, n_tokens[, decodes][, same]) for each row of ``docs``.

    ``decodes``: the ids decode to the normalised text; ``same``: the
    sentencepiece library gives the same ids. The model file, a few hundred KB,
    is read by the driver and sent to the executors.
    """
    with open(model_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        *[T.StructField(n, T.BooleanType()) for n in _names(check_decoding, parity)[3:]],
    ]
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return out.mapInArrow(_encode(data, threads, check_decoding, parity), T.StructType(fields)).withColumnRenamed("id", id_col)


def _decode(data, threads: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        model = _loaded(data.value)
        for part in parts:
            for lo in range(0, part.num_rows, 256):
                ids = part.column(1).slice(lo, 256)
                rows = ids.to_pylist()
                texts = iter(model.decode([r for r in rows if r is not None]))
                out = [None if r is None else next(texts) for r in rows]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, 256), pa.array(out, pa.string())], names=["id", "text"])

    return run


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", threads: int = 2) -> DataFrame:
    """(id, text) for each row; null ids give a null text."""
    with open(model_path, "rb") as f:
        data = encoded.sparkSession.sparkContext.broadcast(f.read())
    kind = T.StructType([T.StructField("id", encoded.schema[id_col].dataType), T.StructField("text", T.StringType())])
    out = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return out.mapInArrow(_decode(data, threads), kind).withColumnRenamed("id", id_col)
