"""Vectorised word and shingle hashing of text batches (numpy, inside tasks).

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return, in the UTF-8 text with A-Z lower-cased:
the pattern ``[^\\x20\\x09-\\x0D]+``. Words and shingles are stood for by 64-bit
hashes. A text is hashed as a whole, never a prefix; batches are cut between
texts only, so one very long text is one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M64 = (1 << 64) - 1
#: Base of the polynomial word hash (odd, so that it has an inverse mod 2**64).
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i below n, kept between batches."""
    if _powers["n"] < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            t = np.full(size, base & _M64, np.uint64)
            t[0] = 1
            _powers[key] = np.multiply.accumulate(t)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3 style): spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def batches(texts: list[str | None], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` with about ``limit`` characters each; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def text_batches(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """Index ranges of an Arrow column with ``limit`` bytes at most and their texts; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(end, end[lo] - size[lo] + limit, side="right")))
        yield lo, hi, texts.slice(lo, hi - lo).to_pylist()
        lo = hi


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data``; equal bytes hash alike wherever they stand."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    # prefix sums of byte * BASE**i: a span's hash is position-free after the inverse power
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a batch of texts, in order: ``hash``, ``doc`` (index in the batch), byte spans.

    ``bytes`` is the lower-cased UTF-8 of all texts, each followed by a space;
    ``raw`` the same before lower-casing.
    """

    def __init__(self, texts: list[str | None]):
        coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        # one space after each text, so that no word spans two texts
        self.raw = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
        self.bytes = _LOWER[self.raw]
        ends_of_text = np.cumsum([len(r) + 1 for r in coded], dtype=np.int64) if coded else np.zeros(0, np.int64)
        space = _SPACE[self.bytes]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate((np.zeros(1, np.int64), edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = span_hashes(self.bytes, self.start, self.end)
        self.doc = np.searchsorted(ends_of_text, self.start, side="right")
        self.n_docs = len(coded)
        self.counts = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles as (document index, 64-bit hash), sorted by both.

    A text of fewer than k words (but at least one) has its whole word sequence
    as its one shingle; a text without words has none.
    """
    h, doc, n = words.hash, words.doc, len(words.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.concatenate((np.zeros(1, np.int64), np.cumsum(words.counts)[:-1]))
    place = np.arange(n) - first[doc]
    left = words.counts[doc] - place
    value = np.zeros(n, np.uint64)
    for j in range(k):
        has = left > j
        part = np.zeros(n, np.uint64)
        part[: max(n - j, 0)] = h[j:]
        step = mix(part + np.uint64((j + 1) * 0xD6E8FEB86659FD93 & _M64))
        value = np.where(has, mix(value + step) if j else step, value)
    keep = (left >= k) | ((place == 0) & (words.counts[doc] < k))
    doc, value = doc[keep], value[keep]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]
