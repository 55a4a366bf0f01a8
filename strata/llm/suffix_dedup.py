"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte is removed when a string of ``SPAN`` bytes that covers it also starts
anywhere else in the corpus.  Sorting the suffixes of the corpus would find these
strings as neighbours that share SPAN bytes; here only suffixes that can have
such a neighbour are sorted, in groups that are sure to hold the neighbour too.

1. Anchors.  Every string of SPAN bytes is assigned the gram of GRAM bytes in it
   with the smallest hash (the leftmost of equals), so equal strings have equal
   anchors at equal places.  Consecutive strings with one anchor form a *cell*;
   a text has about one cell for 85 bytes.
2. Grams that occur once in the corpus are dropped by a grouped count (combined
   map-side).  Where all cells of a gram are the same, each is a repeat as a
   whole.  Only cells that share a gram and differ are looked at closer.
3. Their bytes meet by gram; cells that occur twice are repeats.  The suffixes
   of the distinct cells of a gram are sorted by mergesort.  Two
   suffixes are compared by their longest common extension, found by binary
   search over prefix polynomial hashes, in a logarithmic number of steps.
   Neighbours with SPAN bytes in common are repeats once the bytes are compared.
   Grams with more than CELL_LIMIT cells are not sorted in one task: their
   distinct cells are grouped by bytes, and the strings of these are spread over
   the cluster by two hashes and counted.
4. Spans are joined back to the texts; results are counted in bytes.

Null text counts as empty.  Repeated rows are places of their own, so each is a
repeat of the other.  Matches never cross texts.  Extra columns are kept;
columns with the names of the results are replaced.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, landed, other_columns, quoted, text_digest, unboxed
from .textkern import blocks, mix

SPAN = 200
GRAM = 32
CHUNK_BYTES = 1 << 20  # bytes hashed together; longer texts are read in overlapping chunks
CELL_LIMIT = 16384  # cells of one gram that are sorted in one task

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """Polynomial hashes of all substrings of a buffer, modulo 2**64 over a random value for each byte."""

    def __init__(self, data: np.ndarray):
        n = 1 << max(12, int(len(data) + 1).bit_length())
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, n)[:len(data)], out=self.sums[1:])
        self.back = _powers(_INVERSE, n)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from running minima of aligned blocks."""
    n = len(values) - width + 1
    pad = -len(values) % width
    grid = np.concatenate([values, np.full(pad, _MASK, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def cells_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cells of the texts in a buffer of at most 2**24 bytes: text, start in it, shape, gram and cell hash.

    ``shape`` holds the cell's length and its anchor's place, 16 bits each.
    """
    z = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    hashes = PrefixHash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = mix(hashes.of(at, GRAM))
    low = np.uint64((1 << 24) - 1)
    best = sliding_min((gram & ~low) | at.astype(np.uint64), SPAN - GRAM + 1)
    anchor = (best & low).astype(np.int64)
    # windows inside one text
    ends = offs[1:]
    start = np.flatnonzero(np.repeat(ends, np.diff(offs))[:len(anchor)] - np.arange(len(anchor)) >= SPAN)
    if not len(start):
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    a = anchor[start]
    new = np.ones(len(start), bool)
    new[1:] = (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    p, a = start[first], a[first]
    length = start[last] + SPAN - p
    shape = (length << 16) | (a - p)
    cell = mix(hashes.of(p, length) + shape.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    text = np.searchsorted(offs, p, "right") - 1
    return text, p - offs[text], shape, gram[a], cell


def chunked_cells(texts: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells of all texts; texts longer than a chunk are read in chunks that overlap by SPAN - 1 bytes."""
    for row, data, offs in blocks(texts, CHUNK_BYTES):
        if len(data) <= 2 * CHUNK_BYTES:
            text, p, *rest = cells_of(data, offs)
            yield text + row, p, *rest
        else:  # one long text
            for lo in range(0, len(data) - SPAN + 1, CHUNK_BYTES):
                part = data[lo:lo + CHUNK_BYTES + SPAN - 1]
                text, p, *rest = cells_of(part, np.array([0, len(part)]))
                yield text + row, p + lo, *rest


_CELL = pa.struct([("start", pa.int64()), ("shape", pa.int32()), ("gram", pa.int64()), ("cell", pa.int64())])


@F.arrow_udf(from_arrow_type(pa.list_(_CELL)))
def text_cells(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        parts = list(chunked_cells(texts))
        text, p, shape, gram, cell = (np.concatenate([x[k] for x in parts]) if parts else np.zeros(0, np.int64)
                                      for k in range(5))
        offs = np.concatenate(([0], np.cumsum(np.bincount(text.astype(np.int64), minlength=len(texts)))))
        flat = pa.StructArray.from_arrays(
            [pa.array(p.astype(np.int64)), pa.array(shape.astype(np.int32)), pa.array(gram.view(np.int64)),
             pa.array(cell.view(np.int64))], fields=list(_CELL))
        yield pa.ListArray.from_arrays(pa.array(offs, pa.int32()), flat)


# --- the suffix sort -------------------------------------------------------------------------------------------


class Suffixes:
    """Order of suffixes of a buffer by their first SPAN bytes, decided by hashes of common extensions."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.hashes = PrefixHash(data)
        wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        self.head = np.zeros(len(data), np.uint64)  # first eight bytes: most comparisons end there
        for k in range(8):
            self.head = (self.head << np.uint64(8)) | wide[k:k + len(data)]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension of suffix pairs, at most SPAN, by binary search over prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), np.full(len(x), SPAN, np.int64)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi + 1) // 2
            same = self.hashes.of(x, mid) == self.hashes.of(y, mid)
            lo = np.where(open_ & same, mid, lo)
            hi = np.where(open_ & ~same, mid - 1, hi)

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: bool) -> np.ndarray:
        out = self.head[x] < self.head[y]
        tie = np.flatnonzero(self.head[x] == self.head[y])
        if len(tie):
            a, b = x[tie], y[tie]
            n = self.common(a, b)
            whole = n == SPAN
            step = np.where(whole, 0, n)
            out[tie] = np.where(whole, or_equal, self.data[a + step] < self.data[b + step])
        return out

    def sort(self, suffixes: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Mergesort of the suffixes inside each segment (segments ascend and stay where they are).

        All merges of a round run together: the place of an element is its own
        rank plus its rank in the neighbouring run, found by binary search.
        """
        n = len(suffixes)
        bounds = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
        sizes = np.diff(bounds)
        base, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        here = np.arange(n)
        width = 1
        while width < sizes.max(initial=0):
            run = base + (here - base) // (2 * width) * (2 * width)
            mid, hi = np.minimum(run + width, end), np.minimum(run + 2 * width, end)
            left = here < mid
            lo = np.where(left, mid, run)
            top = np.where(left, hi, mid)
            other = lo.copy()
            live = np.flatnonzero(lo < top)
            while len(live):
                m = (lo[live] + top[live]) // 2
                mine, theirs = suffixes[live], suffixes[m]
                before = np.zeros(len(live), bool)
                for side, equal in ((left[live], False), (~left[live], True)):
                    k = np.flatnonzero(side)
                    before[k] = self.less(theirs[k], mine[k], equal)
                lo[live] = np.where(before, m + 1, lo[live])
                top[live] = np.where(before, top[live], m)
                live = live[lo[live] < top[live]]
            place = np.where(left, here, run + here - mid) + lo - other
            out = np.empty_like(suffixes)
            out[place] = suffixes
            suffixes = out
            width *= 2
        return suffixes

    def repeats(self, suffixes: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Those suffixes whose first SPAN bytes another one of the segment shares."""
        if len(suffixes) < 2:
            return suffixes[:0]
        ordered = self.sort(suffixes, segment)
        x, y = ordered[:-1], ordered[1:]
        at = np.flatnonzero((segment[1:] == segment[:-1]) & (self.head[x] == self.head[y]))
        at = at[self.common(x[at], y[at]) == SPAN]
        views = np.lib.stride_tricks.sliding_window_view(self.data, SPAN)
        sure = [at[i:i + 4096][(views[x[at[i:i + 4096]]] == views[y[at[i:i + 4096]]]).all(axis=1)]
                for i in range(0, len(at), 4096)]
        at = np.concatenate(sure) if sure else at
        return np.unique(np.concatenate([x[at], y[at]]))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the intervals."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    return list(zip(s[first].tolist(), e[last].tolist()))


def repeated_spans(gram: np.ndarray, shape: np.ndarray, count: np.ndarray, cells: list[bytes]) -> list:
    """For each distinct cell the spans that occur again, from the cells of the same gram."""
    data = np.frombuffer(b"".join(cells), np.uint8)
    length, place = shape >> 16, shape & 0xFFFF
    first = np.cumsum(length) - length
    n = length - SPAN + 1
    owner = np.repeat(np.arange(len(cells)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    suffixes = first[owner] + inner
    # equal strings have equal anchors at equal places
    anchored = place[owner] - inner
    number = np.unique(gram, return_inverse=True)[1]
    key = number[owner] * SPAN + anchored
    order = np.argsort(key, kind="stable")
    hit = Suffixes(data).repeats(suffixes[order], key[order])
    whose = np.searchsorted(first, hit, "right") - 1
    cut = np.searchsorted(whose, np.arange(len(cells) + 1))
    out = []
    for i in range(len(cells)):
        if count[i] > 1:
            out.append([(0, int(length[i]))])
        else:
            s = hit[cut[i]:cut[i + 1]] - first[i]
            out.append(merged(s, s + SPAN))
    return out


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_GROUP_BYTES = 2 << 20  # bytes of cells that are sorted together, whole grams at a time


def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, cell, shape, bytes) in order of gram -> (gram, cell, shape, spans) of cells with repeats."""

    def flush(rows):
        distinct = Counter(rows)  # equal cells have equal bytes
        gram, cell, shape, raw = zip(*distinct)
        n = list(distinct.values())
        spans = repeated_spans(np.array(gram), np.array(shape, np.int64), np.array(n), list(raw))
        some = [i for i, x in enumerate(spans) if x]
        return pa.record_batch([
            pa.array([gram[i] for i in some], pa.int64()), pa.array([cell[i] for i in some], pa.int64()),
            pa.array([shape[i] for i in some], pa.int32()),
            pa.array([[{"s": s, "e": e} for s, e in spans[i]] for i in some], _SPANS)],
            names=["gram", "cell", "shape", "spans"])

    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if size >= _GROUP_BYTES and row[0] != rows[-1][0]:
                yield flush(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[3])
    if rows:
        yield flush(rows)


@F.arrow_udf(from_arrow_type(pa.list_(pa.struct([("s", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]))))
def strings_of(cells: pa.Array) -> pa.Array:
    """Place and two hashes of each string of SPAN bytes in a cell."""
    out = []
    for raw in cells.to_pylist():
        data = np.frombuffer(raw, np.uint8)
        at = np.arange(len(data) - SPAN + 1)
        one, two = PrefixHash(data), PrefixHash(data[::-1])
        h1 = mix(one.of(at, SPAN)).view(np.int64)
        h2 = mix(two.of(len(data) - SPAN - at, SPAN)).view(np.int64)
        out.append([{"s": int(s), "h1": int(a), "h2": int(b)} for s, a, b in zip(at, h1, h2)])
    return pa.array(out, pa.list_(pa.struct([("s", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])))


# --- the operator ----------------------------------------------------------------------------------------------


_RESULT = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def result_of(raw: bytes, spans: list[tuple[int, int]]) -> dict:
    kept, at = hashlib.sha256(), 0
    for s, e in spans:
        kept.update(raw[at:s])
        at = e
    kept.update(raw[at:])
    return {"n_bytes": len(raw), "n_removed": sum(e - s for s, e in spans), "n_spans": len(spans),
            "kept_sha256": kept.hexdigest(), "spans": [{"start": s, "end": e} for s, e in spans]}


_INTERVALS = "array<struct<s: long, e: long>>"


@F.arrow_udf(from_arrow_type(_RESULT))
def apply_spans(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Result of removing the intervals of both lists from each text."""
    out = []
    for t, a, b in zip(texts.to_pylist(), one.to_pylist(), two.to_pylist()):
        both = np.array([(x["s"], x["e"]) for x in [*(a or []), *(b or [])]], np.int64).reshape(-1, 2)
        out.append(result_of((t or "").encode(), merged(both[:, 0], both[:, 1])))
    return pa.array(out, _RESULT)


_RAW = pa.list_(pa.struct([("gram", pa.int64()), ("cell", pa.int64()), ("shape", pa.int32()), ("raw", pa.binary())]))


@F.arrow_udf(from_arrow_type(_RAW))
def cell_bytes(texts: pa.Array, cells: pa.Array) -> pa.Array:
    """Bytes of the given cells of each text."""
    out = []
    for t, some in zip(texts.to_pylist(), cells.to_pylist()):
        raw = (t or "").encode()
        out.append([{"gram": c["gram"], "cell": c["cell"], "shape": c["shape"],
                     "raw": raw[c["start"]:c["start"] + (c["shape"] >> 16)]} for c in some or []])
    return pa.array(out, _RAW)


def suffix_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without its text, plus n_bytes, n_removed, n_spans, kept_sha256 and the removed spans."""
    names = [f.name for f in _RESULT]
    own, keep = other_columns(docs, *names, text_col), ["__own"]
    keyed = docs.select(boxed(own), text_digest(id_col, text_col).alias("__key"), F.col(quoted(text_col)).alias("__t"))
    text_col = "__t"

    # cells whose gram occurs again
    listed = landed(keyed.select("__key", F.monotonically_increasing_id().alias("__row"),
                                 text_cells(F.col(text_col)).alias("c")), "cells")
    # the number of a text travels with its cells, its digest does not
    cells = listed.select("__row", F.explode("c").alias("c")).select("__row", "c.*")
    grams = cells.groupBy("gram").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"), F.count("*").alias("n"))
    # landed, so that the join has exchanges of its own and a frequent gram can be split
    grams = landed(grams.filter("n > 1").select("gram", (F.col("lo") == F.col("hi")).alias("same"),
                                                 (F.col("n") > CELL_LIMIT).alias("hot")), "grams")
    again = cells.join(grams, "gram")
    end = F.col("start") + F.shiftright("shape", 16)
    per_row = again.groupBy("__row").agg(
        F.collect_list(F.when(F.col("same"), F.struct(F.col("start").alias("s"), end.alias("e")))).alias("whole"),
        F.collect_list(F.when(~F.col("same"), F.struct("start", "shape", "gram", "cell", "hot"))).alias("unsure"))
    # repeated rows have equal lists: one is enough
    per_text = per_row.join(listed.select("__row", "__key"), "__row").groupBy("__key").agg(
        F.min_by(F.struct("whole", "unsure"), "__row").alias("x")).select("__key", "x.*")

    # texts with cells to look at closer travel on, all others are done
    met = keyed.join(per_text, "__key", "left")
    unsure = F.size(F.coalesce("unsure", F.array().cast("array<struct<start:long,shape:int,gram:long,cell:long,hot:boolean>>"))) > 0
    none = F.lit(None).cast(_INTERVALS)
    # the result of a text that travels on is made later, so no bytes are hashed for it here
    done = apply_spans(F.when(unsure, F.lit(None)).otherwise(F.col(text_col)),
                       F.when(unsure, none).otherwise(F.col("whole")), none)
    met = landed(met.select(*keep, "__key", F.when(unsure, F.col(text_col)).alias("__text"), "unsure",
                            F.when(unsure, F.col("whole")).alias("whole"), unsure.alias("__open"), done.alias("__r")), "met")

    # cells by bytes, sorted in the groups of their grams: the bytes are dealt out once
    open_ = met.filter("__open")

    def raw_cells(which) -> DataFrame:
        some = open_.select("__text", F.filter("unsure", which).alias("c")).filter(F.size("c") > 0)
        return some.select(F.explode(cell_bytes(F.col("__text"), F.col("c"))).alias("c")).select("c.*")

    schema = "gram long, cell long, shape int, spans array<struct<s: int, e: int>>"
    found = raw_cells(lambda c: ~c["hot"]).repartition("gram").sortWithinPartitions("gram").mapInArrow(
        sort_groups, schema)

    # a gram with very many cells: distinct cells, then their strings by two hashes, counted map-side first
    large = landed(raw_cells(lambda c: c["hot"]).groupBy("gram", "cell", "shape", "raw").agg(F.count("*").alias("n")),
                   "hot-cells")
    strings = large.select("gram", "cell", "shape", "n", F.explode(strings_of(F.col("raw"))).alias("w")).select(
        "gram", "cell", "shape", "n", "w.*")
    twice = landed(strings.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2"), "strings")
    # a cell that occurs twice is a repeat as a whole; only the others need their strings back
    spread = strings.filter("n = 1").join(twice, ["h1", "h2"], "left_semi").groupBy("gram", "cell", "shape").agg(
        F.collect_list(F.struct("s", (F.col("s") + SPAN).alias("e"))).alias("spans"))
    whole = large.filter("n > 1").select("gram", "cell", "shape", F.array(
        F.struct(F.lit(0).alias("s"), F.shiftright("shape", 16).alias("e"))).alias("spans"))
    found = landed(found.union(spread).union(whole), "found-spans")

    # back to the texts
    placed = open_.select("__key", F.explode("unsure").alias("c")).select("__key", "c.*").join(
        found, ["gram", "cell", "shape"]).select("__key", F.explode(F.transform("spans", lambda x: F.struct(
            (F.col("start") + x["s"]).alias("s"), (F.col("start") + x["e"]).alias("e")))).alias("x"))
    placed = placed.groupBy("__key").agg(F.collect_set("x").alias("more"))
    closed = met.filter("not __open").select(*keep, "__r.*")
    opened = open_.drop("__r").join(placed, "__key", "left")
    opened = opened.select(*keep, apply_spans(F.col("__text"), F.col("whole"), F.col("more")).alias("__r")).select(
        *keep, "__r.*")
    return closed.union(opened).select(*unboxed(own), *names)


@register("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
