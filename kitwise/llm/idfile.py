"""Token ids in files: canonical length-limited Huffman coding in independent blocks.

A file is a folder of three tables, written by Spark, so commits are atomic and
any store will do:

``codes``   (token, length): the code book. Lengths are the best ones of at most
            ``LIMIT`` bits for the counts of all ids of the corpus (package-merge);
            codes are canonical, in order of length, then token.
``blocks``  (shard, block, first, n, documents, checkpoints, payload): runs of about
            ``BLOCK`` ids in ascending order of document id. ``first`` counts
            the shard's ids before the block; ``documents`` has the parts of
            documents that make up the block (id, ids of the document before
            and after the part, ids in it), each coded from a byte border;
            ``checkpoints`` are the bit offsets of every ``STEP``-th id of
            each part. A block is decoded by itself, all checkpoints abreast,
            by looking up the next bits in one table.
``shards``  (shard, start): the ids before each shard.

Texts are encoded once, in units that are kept in a table: a byte-level
tokenizer's words never go on over a space that follows another character, nor
from an ASCII letter to a mark, so a text's ids are those of its units in turn. New units are encoded many at a time, joined, and told apart by the
lengths of their tokens. Ids are counted as they are made, coded once into a table, and only then moved, by
one range exchange of the codes. Strings of special tokens in a text are
ordinary text.

Edge cases: a null text is an empty one, which has the end id alone. Null ids
come first; rows that repeat an id are documents of their own, in order of
length and hash. A document of any length is cut into parts of ``BLOCK`` ids.
An empty table gives empty tables. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kitwise.llm.pieces import BATCH
from kitwise.llm.scratch import Scratch
from kitwise.llm.words import batches, span_hashes

#: Bits of a code at most; ids of a block; ids from one checkpoint to the next.
LIMIT, BLOCK, STEP = 18, 1 << 15, 256
#: Ids that are packed, and decoded, at once.
PACKED, AT_ONCE = 1 << 19, 1 << 21
#: Units that a table holds before it forgets the seldom used.
KEPT = 1 << 20
#: New units that the library gets in one text.
JOINED = 1024


# Text to ids -----------------------------------------------------------------------------------
_LETTER, _MARK = (np.array([i < 0x80 and test(chr(i)) for i in range(256)]) for test in (str.isalpha, lambda c: c.isprintable() and not c.isalnum() and c != " "))


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indexes of the runs that begin at ``start`` and have ``size`` places."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _room(column: np.ndarray, n: int) -> np.ndarray:
    """The column with room for ``n`` entries at least."""
    return column if n <= len(column) else np.concatenate((column, np.zeros(max(n, 2 * len(column)) - len(column), column.dtype)))


class Units:
    """Ids of units: ``n`` numbered entries, whose numbers stand in ``slots`` at the first bits of their hashes or in the next free place."""

    def __init__(self):
        self.n, self.n_ids = 0, 0
        self.hash, self.length = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        self.first, self.size, self.used = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(1, np.int32)
        self._deal()

    def _deal(self) -> None:
        """All entries in new slots, a quarter of them taken at most."""
        bits = (4 * self.n + 4).bit_length()
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)
        self._place(np.arange(self.n))

    def _place(self, entry: np.ndarray) -> None:
        at = (self.hash[entry] >> self.shift).astype(np.int64)
        while len(entry):
            free = self.slots[at] < 0
            self.slots[at[free]] = entry[free]  # the last of those that want one place has it
            lost = self.slots[at] != entry
            entry, at = entry[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def find(self, hash_: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The entry of each unit, -1 where there is none."""
        out, left = np.full(len(hash_), -1), np.arange(len(hash_))
        at = (hash_ >> self.shift).astype(np.int64)
        while len(left):
            entry = self.slots[at]
            same = (entry >= 0) & (self.hash[entry] == hash_) & (self.length[entry] == length)
            out[left[same]] = entry[same]
            on = np.flatnonzero((entry >= 0) & ~same)
            left, at, hash_, length = left[on], (at[on] + 1) & (len(self.slots) - 1), hash_[on], length[on]
        return out

    def add(self, hash_: np.ndarray, length: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New entries, all their ids in one array."""
        lo, hi = self.n, self.n + len(hash_)
        first = self.n_ids + np.cumsum(size) - size
        for name, new in (("hash", hash_), ("length", length), ("first", first), ("size", size), ("used", 0)):
            column = _room(getattr(self, name), hi)
            column[lo:hi] = new
            setattr(self, name, column)
        self.flat = _room(self.flat, self.n_ids + len(ids))
        self.flat[self.n_ids : self.n_ids + len(ids)] = ids
        self.n, self.n_ids = hi, self.n_ids + len(ids)
        if 2 * self.n > len(self.slots):
            self._deal()
        else:
            self._place(np.arange(lo, hi))

    def ids(self, entry: np.ndarray) -> np.ndarray:
        """All ids of the entries, one after another."""
        return self.flat[_runs(self.first[entry], self.size[entry])]

    def count(self, entry: np.ndarray) -> None:
        self.used[: self.n] += np.bincount(entry, minlength=self.n)

    def shrink(self) -> None:
        """Forget the units used less than twice since the last time."""
        kept = np.flatnonzero(self.used[: self.n] > 1)
        flat, columns = self.ids(kept), [c[kept] for c in (self.hash, self.length, self.size)]
        self.__init__()
        self.add(columns[0], columns[1], flat, columns[2])


class Encoder:
    """A byte-level tokenizer of the tokenizers library with a table of units."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        # a token's string has one character a byte
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.table = Units()

    @staticmethod
    def ends(data: np.ndarray) -> np.ndarray:
        """Whether a place holds the last byte of a character that is certainly no white space: ASCII marks, and two-byte characters but U+0080 to U+00BF."""
        out = (data > 0x20) & (data < 0x7F)
        out[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        return out

    @staticmethod
    def begins(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where a unit begins whatever stands around it."""
        out = np.zeros(len(data), bool)
        out[1:] = ends[:-1] & ((data[1:] == 0x20) | (data[1:] == 0x0A))  # white space after another character
        out[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
        out[2:] |= ends[:-2] & (data[1:-1] == 0x0A) & ends[2:] & (data[2:] < 0x80)  # after a line feed that stands alone
        return out

    def _new(self, joined: bytes, start: np.ndarray, end: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some units, and the number of each one's; ``whole``: units that end in a character that is no white space."""
        first = np.frombuffer(joined, np.uint8)[start]
        spaced = whole & ((first == 0x20) | (first == 0x0A))
        # a line feed before other units keeps them apart; its id is taken out again
        led = whole & ((first > 0x20) & (first < 0x7F) | (first >= 0xC3) & (first < 0xE0))
        units = [joined[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        size, runs, placed = np.zeros(len(units), np.int64), [], []
        together = np.flatnonzero(spaced | led)
        for lo in range(0, len(together), JOINED):
            some = together[lo : lo + JOINED]
            text = b"".join(b"\n" + units[i] if with_feed else units[i] for i, with_feed in zip(some.tolist(), led[some].tolist(), strict=True))
            ids = self._encode([text.decode()])[0]
            cuts = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum((end - start)[some] + led[some])) + 1
            begin = np.append(0, cuts[:-1])
            feeds = begin[led[some]]
            runs.append(np.delete(ids, feeds))
            size[some] = cuts - begin - led[some]
            placed.append(some)
        alone = np.flatnonzero(~(spaced | led))
        for i, ids in zip(alone.tolist(), self._encode([units[i].decode() for i in alone.tolist()]), strict=True):
            runs.append(ids)
            size[i] = len(ids)
            placed.append(np.array([i]))
        order = np.concatenate([np.zeros(0, np.int64), *placed])
        at = np.empty(len(units), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate([np.zeros(0, np.int64), *runs])[_runs(at, size)], size

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and the number of each text's ids."""
        coded = [t.encode() for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        joined = b"".join(coded)
        data = np.frombuffer(joined, np.uint8)
        ends = self.ends(data)
        begins = self.begins(data, ends)
        begins[(np.cumsum(size) - size)[size > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        hash_, length = span_hashes(data, start, end), end - start
        table = self.table
        if table.n > KEPT:
            table.shrink()
        at = table.find(hash_, length)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            _, once, which = np.unique(hash_[missing], return_index=True, return_inverse=True)
            at[missing] = table.n + which
            new = missing[once]
            ids, n = self._new(joined, start[new], end[new], ends[end[new] - 1])
            table.add(hash_[new], length[new], ids, n)
        table.count(at)
        before = np.append(0, np.cumsum(table.size[at]))  # ids before a unit
        border = before[np.searchsorted(start, np.append(0, np.cumsum(size)))]
        return table.ids(at), np.diff(border)


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def _ids_of(definition, end_id: int, width: str, id_type: pa.DataType):
    """(id, ids, counts): the ids of each text, and last a row with how often the task's texts have each id."""
    tally = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        total = np.zeros(max(len(encoder.bytes), end_id + 1), np.int64)
        for part in parts:
            texts = part.column(1).to_pylist()
            for lo, hi in batches(texts, BATCH):
                ids, n = encoder.encode([t or "" for t in texts[lo:hi]])
                ids = np.insert(ids, np.cumsum(n), end_id)
                total += np.bincount(ids, minlength=len(total))
                coded, cut = ids.astype(width).tobytes(), (np.append(0, np.cumsum(n + 1)) * np.dtype(width).itemsize).tolist()
                own = [coded[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                columns = [part.column(0).slice(lo, hi - lo), pa.array(own, pa.binary()), pa.nulls(hi - lo, tally)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "counts"])
        counts = [{"token": t, "n": int(total[t])} for t in np.flatnonzero(total).tolist()]
        columns = [pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([counts], tally)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "counts"])

    return run


# The code --------------------------------------------------------------------------------------
def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The best code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids have no codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    coins = counts[order].astype(np.int64)
    levels, row = [], coins
    is_coin = np.ones(n, bool)
    for _ in range(limit - 1):
        levels.append(is_coin)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((coins, pairs))
        sort = np.argsort(both, kind="stable")
        row, is_coin = both[sort], sort < n
    levels.append(is_coin)
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_coin in reversed(levels):
        coins_taken = int(is_coin[:taken].sum())
        lengths[:coins_taken] += 1
        taken = 2 * (taken - coins_taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """The canonical code of tokens with given lengths."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((tokens, lengths))
        tokens, lengths = tokens[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(lengths.max(initial=1))
        # a code is the number of table places before it, shortened to its length
        places = np.int64(1) << (self.bits - lengths)
        before = np.cumsum(places) - places
        size = int(tokens.max(initial=0)) + 1
        self.length, self.code = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.length[tokens], self.code[tokens] = lengths, before >> (self.bits - lengths)
        spare = max((1 << self.bits) - int(places.sum()), 0)  # a lone token has half the table
        self.next_token = np.concatenate((np.repeat(tokens, places), np.zeros(spare, np.int64))).astype(np.int32)
        self.next_length = np.concatenate((np.repeat(lengths, places), np.ones(spare, np.int64))).astype(np.uint8)

    def pack(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The codes of runs of ids, each from a byte border: bytes, the runs' byte borders, and every id's bit offset."""
        length = self.length[ids]
        ends = np.cumsum(length)
        last = np.cumsum(sizes)
        bits = np.diff(np.append(0, np.append(0, ends)[last]))
        border = np.append(0, np.cumsum((bits + 7) // 8))
        own = ends - length - np.repeat(np.cumsum(bits) - bits, sizes)
        offset = own + np.repeat(8 * border[:-1], sizes)
        word, within = offset >> 5, offset & 31
        value = self.code[ids].astype(np.uint64) << (64 - within - length).astype(np.uint64)
        n = int(border[-1]) // 4 + 2
        # bits of different ids never meet, so their sums in doubles are exact
        words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n) + np.bincount(
            word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n]
        return words.astype(">u4").tobytes()[: int(border[-1])], border, own

    def unpack(self, payload: bytes, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of lanes that begin at bit ``offsets``, one lane after another."""
        padded = payload + bytes(8 + -len(payload) % 4)
        words = np.frombuffer(padded, ">u4").astype(np.uint64)
        out = np.empty(int(sizes.sum()), np.int32)
        longest_first = np.argsort(-sizes, kind="stable")
        at, left = offsets[longest_first].astype(np.int64), sizes[longest_first]
        place = (np.cumsum(sizes) - sizes)[longest_first]
        shift, mask = np.uint64(64 - self.bits), np.uint64((1 << self.bits) - 1)
        for step in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-left, -step, side="left"))  # lanes with more than ``step`` ids
            now = at[:active]
            word = now >> 5
            window = (words[word] << np.uint64(32)) | words[word + 1]
            key = (window >> (shift - (now & 31).astype(np.uint64))) & mask
            out[place[:active] + step] = self.next_token[key]
            now += self.next_length[key]
        return out


@lru_cache(maxsize=2)
def _code(book: bytes) -> Code:
    both = np.frombuffer(book, np.int64).reshape(2, -1)
    return Code(both[0], both[1])


def _book(codes: DataFrame) -> bytes:
    """The code book of a file, one entry a token of the vocabulary at most."""
    rows = codes.select("token", "length").collect()
    return np.array([[r[0] for r in rows], [r[1] for r in rows]], np.int64).tobytes()


# Writing ---------------------------------------------------------------------------------------
def _coded(book, width: str):
    """Parts of documents: (id, size, hash, row, before, n, after, checkpoints, payload)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(book.value)
        wide = np.dtype(width).itemsize
        for part in parts:
            rows = part.column(part.schema.get_field_index("ids")).to_pylist()
            held = [(i, lo, len(r)) for i, r in enumerate(rows) for lo in range(0, len(r), BLOCK * wide)]
            for a, b in _groups([min(n - lo, BLOCK * wide) // wide for _, lo, n in held], PACKED):
                some = held[a:b]
                ids = np.frombuffer(b"".join(rows[i][lo : lo + BLOCK * wide] for i, lo, _ in some), width).astype(np.int64)
                sizes = np.array([min(n - lo, BLOCK * wide) // wide for _, lo, n in some], np.int64)
                payload, border, offset = code.pack(ids, sizes)
                begin = np.append(0, np.cumsum(sizes)).tolist()
                marks = [offset[x:y:STEP].astype("<u4").tobytes() for x, y in zip(begin, begin[1:], strict=False)]
                cut = border.tolist()
                own = part.take(pa.array([i for i, _, _ in some], pa.int64()))
                columns = [own.column(own.schema.get_field_index(c)) for c in ("id", "size", "hash", "row")]
                before = np.array([lo // wide for _, lo, _ in some], np.int64)
                after = np.array([(n - lo) // wide for _, lo, n in some], np.int64) - sizes
                columns += [pa.array(before), pa.array(sizes), pa.array(after), pa.array(marks, pa.binary()),
                            pa.array([payload[x:y] for x, y in zip(cut, cut[1:], strict=False)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "hash", "row", "before", "n", "after", "checkpoints", "payload"])

    return run


def _groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges with at most ``limit`` in sum; what is larger stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _blocked(id_type: pa.DataType):
    """Blocks of a shard's parts, which come in order."""
    part_type = pa.struct([("id", id_type), ("before", pa.int64()), ("n", pa.int64()), ("after", pa.int64())])

    def block(shard: int, number: int, first: int, held: list[dict]) -> pa.RecordBatch:
        payload = b"".join(h["payload"] for h in held)
        at = np.cumsum([0, *[len(h["payload"]) for h in held]])
        marks = np.concatenate([np.frombuffer(h["checkpoints"], "<u4") + 8 * x for h, x in zip(held, at.tolist(), strict=False)])
        own = [{"id": h["id"], "before": h["before"], "n": h["n"], "after": h["after"]} for h in held]
        n = sum(h["n"] for h in held)
        values = (shard, number, first, n, own, marks.astype("<u4").tobytes(), payload)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(part_type), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=list(BLOCK_COLUMNS))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        number, first, held, n = 0, 0, [], 0
        for part in parts:
            for row in part.to_pylist():
                if held and n + row["n"] > BLOCK:
                    yield block(shard, number, first, held)
                    number, first, held, n = number + 1, first + n, [], 0
                held.append(row)
                n += row["n"]
        if held:
            yield block(shard, number, first, held)

    return run


BLOCK_COLUMNS = ("shard", "block", "first", "n", "documents", "checkpoints", "payload")


def _block_type(id_type: T.DataType) -> T.StructType:
    document = T.StructType([T.StructField("id", id_type), *[T.StructField(c, T.LongType()) for c in ("before", "n", "after")]])
    kinds = (T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(document), T.BinaryType(), T.BinaryType())
    return T.StructType([T.StructField(c, k) for c, k in zip(BLOCK_COLUMNS, kinds, strict=True)])


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The ids of every text of ``docs``, each followed by ``end_id``, as a file at ``path`` (which must not exist)."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    scratch = Scratch(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    widest = max(end_id, *_encoder(definition).tokenizer.get_vocab().values())
    width = "<u2" if widest < 1 << 16 else "<u4"
    id_field = T.StructField("id", docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tally = T.ArrayType(T.StructType([T.StructField("token", T.LongType()), T.StructField("n", T.LongType())]))
    kind = T.StructType([id_field, T.StructField("ids", T.BinaryType()), T.StructField("counts", tally)])
    encode = _ids_of(sc.broadcast(definition), end_id, width, to_arrow_type(id_field.dataType))
    ids = scratch.save(rows.mapInArrow(encode, kind), "ids", compression="zstd")
    counts = ids.select(F.explode("counts").alias("c")).groupBy("c.token").agg(F.sum("c.n").alias("n"))
    counts = counts.orderBy("token").collect()  # one row a token of the vocabulary at most
    token, n = (np.array([r[i] for r in counts], np.int64) for i in range(2))
    lengths = code_lengths(n, max(LIMIT, int(len(n)).bit_length()))
    book = spark.createDataFrame(list(zip(token.tolist(), lengths.tolist(), strict=True)), "token long, length long")
    book.coalesce(1).write.parquet(f"{path}/codes")
    data = sc.broadcast(np.stack((token, lengths)).tobytes())
    part = T.StructType([
        id_field, *[T.StructField(c, T.LongType()) for c in ("size", "hash", "row", "before", "n", "after")],
        T.StructField("checkpoints", T.BinaryType()), T.StructField("payload", T.BinaryType()),
    ])
    told = ids.where("ids IS NOT NULL").select("id", F.length("ids").cast("long").alias("size"), F.xxhash64("ids").alias("hash"),
                      F.monotonically_increasing_id().alias("row"), "ids")
    order = ("id", "size", "hash", "row", "before")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written, as a range exchange reads its input twice
    coded = scratch.save(told.mapInArrow(_coded(data, width), part), "coded", compression="uncompressed")
    scratch.drop("ids")
    coded = coded.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    blocks = coded.select("id", "before", "n", "after", "checkpoints", "payload").mapInArrow(
        _blocked(to_arrow_type(id_field.dataType)), _block_type(id_field.dataType))
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    scratch.drop("coded")
    sums = spark.read.schema(_block_type(id_field.dataType)).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    shards = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))
    shards.coalesce(1).write.parquet(f"{path}/shards")


# Reading ---------------------------------------------------------------------------------------
def decoded(code: Code, blocks: list[dict]) -> Iterator[tuple[dict, int, dict, np.ndarray]]:
    """(block, its part's first id in the shard, part, ids) of all parts of some blocks, decoded abreast."""
    parts = [(b, p) for b in blocks for p in b["documents"]]
    sizes = np.array([p["n"] for _, p in parts], np.int64)
    lanes = (sizes + STEP - 1) // STEP
    lane_size = np.full(int(lanes.sum()), STEP, np.int64)
    lane_size[np.cumsum(lanes) - 1] = sizes - (lanes - 1) * STEP
    at = np.cumsum([0, *[len(b["payload"]) for b in blocks]])
    marks = [np.frombuffer(b["checkpoints"], "<u4").astype(np.int64) + 8 * x for b, x in zip(blocks, at.tolist(), strict=False)]
    ids = code.unpack(b"".join(b["payload"] for b in blocks), np.concatenate(marks), lane_size)
    begin, here, first = 0, None, 0
    for b, p in parts:
        if b is not here:
            here, first = b, b["first"]
        yield b, first, p, ids[begin : begin + p["n"]]
        begin, first = begin + p["n"], first + p["n"]


def _read(book, row_of, schema: pa.Schema):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(book.value)
        for part in parts:
            blocks = part.to_pylist()
            for lo, hi in _groups([b["n"] for b in blocks], AT_ONCE):
                rows = [row_of(*found) for found in decoded(code, blocks[lo:hi])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _rows(spark: SparkSession, path: str, row_of, names: str, kinds: list[T.DataType]) -> DataFrame:
    """What ``row_of`` makes of every part, with its ``id``, ``before`` and the place of its document in all ids."""
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["documents"].dataType.elementType["id"].dataType
    kind = T.StructType([T.StructField("id", id_type), *[T.StructField(n, k) for n, k in zip(names.split(), kinds, strict=True)]])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in kind])
    book = spark.sparkContext.broadcast(_book(spark.read.parquet(f"{path}/codes")))
    rows = blocks.mapInArrow(_read(book, row_of, arrow), kind).join(spark.read.parquet(f"{path}/shards"), "shard")
    return rows.withColumn("start", F.col("start") + F.col("first") - F.col("before")).drop("shard", "first")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, before, ids): the parts of every document, ``before`` ids after its ``start`` in the whole file."""
    row_of = lambda b, first, p, ids: (p["id"], b["shard"], first, p["before"], ids)
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType())]
    return _rows(spark, path, row_of, "shard first before ids", kinds).select("id", "start", "before", "ids")


def _x_power(n: int) -> int:
    """x**(8 n) modulo the CRC-32 polynomial, bits reflected."""
    out, square = 1 << 31, 1 << 23
    while n:
        if n & 1:
            out = _times(out, square)
        square = _times(square, square)
        n >>= 1
    return out


def _times(a: int, b: int) -> int:
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


def crc_part(ids: np.ndarray, after: int) -> int:
    """What a run of ids gives to the CRC-32 of its document; ``after`` ids follow. The parts' exclusive or is the whole."""
    own = zlib.crc32(ids.astype("<u4").tobytes())
    return _times(own, _x_power(4 * after)) if after else own


def check_sums(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of a file."""
    row_of = lambda b, first, p, ids: (p["id"], b["shard"], first, p["before"], p["n"], crc_part(ids, p["after"]))
    kinds = [T.IntegerType(), *[T.LongType()] * 4]
    parts = _rows(spark, path, row_of, "shard first before n crc", kinds)
    return parts.groupBy("id", "start").agg(F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))


def write_and_check(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every row of ``docs``, read back from a file in the shared folder."""
    path = f"{Scratch(docs.sparkSession).folder}/file"
    write(docs, path, tokenizer_path, end_id, id_col, text_col)
    return check_sums(docs.sparkSession, path).withColumnRenamed("id", id_col)
