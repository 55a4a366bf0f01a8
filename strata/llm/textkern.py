"""Vectorised text helpers that run inside Arrow batches.

A batch of texts is one UTF-8 byte buffer plus offsets.  Every helper works on
whole texts; ``blocks`` only bounds how many bytes are looked at together, and
a text longer than the bound forms a block of its own.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20

# The separators of words, \x20 and \x09-\x0D.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SEPARATORS)] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and int64 offsets of a string array; nulls become empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[texts.offset:texts.offset + n + 1]
    if bufs[2] is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts with about ``limit`` bytes each."""
    data, offs = utf8(texts)
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def giving_back(fn):
    """Decorator of an Arrow function: at its end a worker, which Spark keeps for later stages, frees what it no longer uses."""
    @functools.wraps(fn)
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)
    return run


class Remembered(dict):
    """What a worker has found out about words, bounded by bytes.

    Two generations: ``settle``, called after each batch, turns a full one into the
    old one and drops the one before.  Words in use move on to the young one, so
    frequent words stay; a batch's own words are the only ones beyond the bound.
    """

    LIMIT = 112 << 20  # bytes of a generation
    ENTRY = 200  # bytes of an entry besides its characters

    def __init__(self):
        self.bytes, self.old = 0, {}

    def learn(self, word: str, value) -> None:
        self[word] = value
        self.bytes += self.ENTRY + (len(word) if word.isascii() else 4 * len(word)) + (len(value) if isinstance(value, bytes) else 0)

    def unknown(self, words) -> list[str]:
        """Those of the distinct ``words`` that are in neither generation; all others are in the young one then."""
        out = []
        for w in [w for w in words if w not in self]:
            value = self.old.get(w)
            if value is None:
                out.append(w)
            else:
                self.learn(w, value)
        return out

    def settle(self) -> None:
        if self.bytes > self.LIMIT:
            self.old = dict(self) if self.bytes <= 2 * self.LIMIT else {}  # one batch of very long words is not kept
            self.clear()
            self.bytes = 0


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer of 64-bit values (wraps modulo 2**64)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of a block: dictionary ids, 64-bit hashes and per-text offsets."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False):
        n = len(data)
        if lower:
            data = LOWER[data]
        solid = ~IS_SPACE[data]
        before = np.ones(n, dtype=bool)
        if n:
            before[1:] = ~solid[:-1]
            heads = offs[:-1]
            before[heads[heads < n]] = True
        starts = np.flatnonzero(solid & before)
        packed = data[solid]
        cum = np.cumsum(solid)
        woffs = np.empty(len(starts) + 1, np.int64)
        woffs[:-1] = cum[starts] - 1 if n else 0
        woffs[-1] = len(packed)
        self.starts = starts
        self.lens = np.diff(woffs)
        self.offs = np.searchsorted(starts, offs)
        kind, width = (pa.binary(), np.int32) if len(packed) < 2**31 - 1 else (pa.large_binary(), np.int64)
        values = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(woffs.astype(width)), pa.py_buffer(packed)])
        coded = values.dictionary_encode()
        self.ids = coded.indices.to_numpy(zero_copy_only=False)
        self.vocabulary = coded.dictionary

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit hash for each word (letters A-Z lower-cased on demand), the same in every batch."""
        distinct = self.vocabulary.to_pylist()
        if lower:
            distinct = map(bytes.lower, distinct)
        table = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(self.vocabulary))
        return table[self.ids] if len(table) else np.zeros(0, np.uint64)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (len(h) - n + 1 of them, or none)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[j:j + m]
    return mix(out)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles.

    Letters A-Z are lower-cased.  A text with fewer than ``n`` words has its
    whole word sequence as its one shingle; one without words has none.
    """
    for _, data, offs in blocks(texts):
        words = Words(data, offs, lower=True)
        h = words.hashes()
        w = window_hashes(h, n)
        for a, b in zip(words.offs[:-1], words.offs[1:]):
            if b - a >= n:
                yield np.unique(w[a:b - n + 1])
            elif b > a:
                whole = window_hashes(h[a:b], int(b - a))
                yield mix(whole + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
