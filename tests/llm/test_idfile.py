"""Token-id files: the library's ids, round trips, best code lengths, check sums."""

import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kitwise.llm import idfile, queries
from kitwise.llm.scratch import Scratch

from .conftest import documents

SF001 = "/root/testdata/sf0.01"
TOKENIZER = f"{queries.TOKENIZERS}/{queries.BYTE_BPE}"
SPACES = [" ", "  ", "\n", " \n", "\t ", " ", "  ", "　", "  ", "\u0085", "\x7f ", "\r\n"]
WORDS = ["the", "don't", "Ünder", "日本語", "🎉", "x_9", "ñ", "1234567", "...", "'s", "</s>", "<|endoftext|>", "a" * 90, "é", "\x00", "Ѐ", "¿qué?"]


def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    return tok


def odd_texts(n, seed=2):
    rnd = random.Random(seed)
    texts = ["", " ", "\n\n", " a", "a ", " a ", "  a  b  ", "a  b", "a  b"]
    texts += ["".join(rnd.choice(SPACES) + rnd.choice(WORDS) * rnd.randint(0, 2) for _ in range(rnd.randint(1, 30))) for _ in range(n)]
    return texts


def test_units_give_the_ids_of_whole_texts():
    texts = odd_texts(600)
    encoder = idfile.Encoder(open(TOKENIZER, encoding="utf-8").read())
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from the table
        ids, n = encoder.encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == want


def huffman_cost(counts):
    """The bits of an unlimited Huffman code."""
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def best_limited(counts, limit):
    """The bits of the best code of at most ``limit`` bits, by trying all lengths."""

    def go(rest, room):  # room in units of 2**-limit
        if not rest:
            return 0
        found = [c + b * rest[0] for b in range(1, limit + 1) if (left := room - (1 << limit - b)) >= 0 and (c := go(rest[1:], left)) is not None]
        return min(found, default=None)

    return go(sorted(counts), 1 << limit)


def test_code_lengths():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 3, 50, 700):
        counts = rnd.integers(1, 1000, n)
        lengths = idfile.code_lengths(counts, 30)
        assert n == 1 or (lengths @ counts == huffman_cost(counts.tolist()) and (0.5**lengths).sum() == 1)
    for counts in ([1, 2, 4, 8, 16, 32], [5, 5, 1, 90, 2], [1, 1, 1, 1, 1, 500, 7]):
        for limit in (3, 4, 5):
            lengths = idfile.code_lengths(np.array(counts), limit)
            assert lengths.max() <= limit and lengths @ np.array(counts) == best_limited(counts, limit)
    fibonacci = [1, 1]
    while len(fibonacci) < 40:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    assert idfile.code_lengths(np.array(fibonacci)).max() == idfile.LIMIT
    with pytest.raises(ValueError):
        idfile.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("n_tokens", [1, 2, 3000])
def test_pack_and_unpack(n_tokens):
    rnd = np.random.default_rng(5)
    ids = (rnd.zipf(1.3, 20000) % n_tokens).astype(np.int64)
    tokens, counts = np.unique(ids, return_counts=True)
    lengths = idfile.code_lengths(counts)
    code = idfile.Code(tokens, lengths)
    sizes = np.array([1, 700, 0, 5000, 14299])
    payload, border, offset = code.pack(ids, sizes)
    assert border[-1] == len(payload) and len(payload) <= (lengths @ counts + 7 * 5) / 8
    first = np.append(0, np.cumsum(sizes))
    lane_at, lane_n, want = [], [], []
    for i in range(5):
        for a in range(0, sizes[i], 64):
            lane_at.append(8 * border[i] + offset[first[i] + a])
            lane_n.append(min(64, sizes[i] - a))
            want.append(ids[first[i] + a : first[i] + a + lane_n[-1]])
    assert code.unpack(payload, np.array(lane_at), np.array(lane_n)).tolist() == np.concatenate(want).tolist()


def test_check_sums_of_parts():
    ids = np.random.default_rng(6).integers(0, 50257, 1000)
    for cuts in ([], [1], [10, 500, 999]):
        parts = np.split(ids, cuts)
        after = 1000 - np.cumsum([len(p) for p in parts])
        assert np.bitwise_xor.reduce([idfile.crc_part(p, int(a)) for p, a in zip(parts, after, strict=True)]) == zlib.crc32(ids.astype("<u4").tobytes())


def plain(rows):
    """[(id, start, n, crc32)] by the library on whole texts, in order of id, length and what the hash decides."""
    tok, out = library(), []
    for doc, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_file_equals_the_library(spark):
    rows = list(enumerate(odd_texts(60))) + [(7, "twice"), (7, "twice"), (None, None), (None, "x y"), (500, "word é " * 30000)]
    df = documents(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "n").repartition(5)
    got = idfile.write_and_check(df, TOKENIZER, 2).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (d is not None, d or 0, n, c) for d, n, c in plain(rows))
    total = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == total
        total += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))


def test_reading_gives_the_ids_back(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts(20, seed=9))] + [(99, "some words " * 20000)]
    path = f"{Scratch(spark).folder}/ids"
    idfile.write(documents(spark, rows), path, TOKENIZER, 2)
    parts = idfile.read(spark, path).orderBy("id", "before").collect()
    whole = {}
    for p in parts:
        assert p["before"] == len(whole.get(p["id"], []))
        whole.setdefault(p["id"], []).extend(p["ids"])
    tok = library()
    assert whole == {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in rows}
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.where(F.col("n") > idfile.BLOCK).count() == 0 and len([p for p in parts if p["id"] == 99]) == 2


def test_empty_table(spark):
    assert idfile.write_and_check(documents(spark, []), TOKENIZER, 2).count() == 0


def test_query_on_a_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want, start = {}, 0
    for doc, n, crc in sorted(plain(rows)):
        want[doc] = (start, n, crc)
        start += n
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op11_idfile(spark, SF001).collect()} == want


def test_ids_are_counted_as_they_are_made(spark):
    """One row a task has its counts; they sum to the ids of all texts, ends included."""
    with open(TOKENIZER, encoding="utf-8") as f:
        definition = f.read()
    texts = ["one two two", None, "", "two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    kind = "id long, ids binary, counts array<struct<token: long, n: long>>"
    made = docs.mapInArrow(idfile._ids_of(spark.sparkContext.broadcast(definition), 2, "<u2", pa.int64()), kind).collect()
    rows = [r for r in made if r["counts"] is None]
    assert sorted(r["id"] for r in rows) == [0, 1, 2, 3]
    told: dict[int, int] = {}
    for r in made:
        for c in r["counts"] or []:
            told[c["token"]] = told.get(c["token"], 0) + c["n"]
    ids = np.concatenate([np.frombuffer(r["ids"], "<u2") for r in rows])
    token, n = np.unique(ids, return_counts=True)
    assert told == dict(zip(token.tolist(), n.tolist(), strict=True)) and told[2] == 4


def test_every_document_is_coded_once(spark, monkeypatch):
    """A range exchange reads its input twice; what it reads is a table."""
    coded, seen = idfile._coded, spark.sparkContext.accumulator(0)

    def counting(book, width):
        run = coded(book, width)

        def counted(parts):
            for part in parts:
                seen.add(part.num_rows)
                yield from run(iter([part]))

        return counted

    monkeypatch.setattr(idfile, "_coded", counting)
    idfile.write(documents(spark, [(i, f"text {i}") for i in range(50)]), f"{Scratch(spark).folder}/ids", TOKENIZER, 2)
    assert seen.value == 50


def test_units_are_found_again():
    rnd = np.random.default_rng(7)
    table, want = idfile.Units(), {}
    assert table.find(np.array([0, 5], np.uint64), np.array([0, 1])).tolist() == [-1, -1]
    for turn in range(6):  # many hashes with the same first bits
        hash_ = np.unique(rnd.integers(0, 1 << 40, 400, dtype=np.uint64) | np.uint64((1 << 64) - (1 << 41)))
        hash_ = hash_[table.find(hash_, np.full(len(hash_), turn)) < 0]
        size = rnd.integers(0, 4, len(hash_))
        ids = rnd.integers(0, 50000, size.sum())
        table.add(hash_, np.full(len(hash_), turn), ids, size)
        runs = np.split(ids, np.cumsum(size)[:-1])
        want |= {(int(h), turn): r.tolist() for h, r in zip(hash_, runs, strict=True)}

    def check():
        keys = list(want)
        at = table.find(np.array([h for h, _ in keys], np.uint64), np.array([n for _, n in keys]))
        assert (at >= 0).all() and table.n == len(keys)
        assert table.ids(at).tolist() == sum((want[k] for k in keys), [])
        assert (table.find(np.array([h for h, _ in keys], np.uint64), np.array([n + 1 for _, n in keys])) < 0).all()
        return keys, at

    keys, at = check()
    table.count(np.concatenate((at[::2], at[::2], at[1::2])))
    table.shrink()
    want = {k: want[k] for k in keys[::2]}
    check()
