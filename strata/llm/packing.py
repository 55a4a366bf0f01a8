"""Best-fit packing by bin completion.

1. Every text becomes token ids plus one end id; only texts longer than a
   sequence are cut, into full pieces and a last shorter one.  Words between
   spaces or line ends are encoded once per batch, because the tokeniser never
   joins across white space.  Pieces (no ids, only a checksum) are landed.
2. The lengths alone decide how to pack, and there are at most ``CAPACITY``
   different ones: a histogram of fixed size, whatever the number of documents.
   Bin completion works on it: the longest length left is completed by a
   branch-and-bound over fillings (longer lengths first, pruned by the waste of
   the incumbent, without a dominance test, ended after a number of nodes), and
   the filling is used as often as the counts allow; a sequence once made is not
   reconsidered.  Plans made with different search efforts compete.
3. Pieces of one length are interchangeable, so each takes its place from its
   rank among those of its length.  Ranks come from per-bucket counts and their
   running sums; no length, however frequent, meets in one task.

Null text counts as empty (its one end id).  Repeated rows are packed as often
as they occur.  Other columns of the input are kept unless they clash.
"""

from __future__ import annotations

import functools
import os
import random
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, landed, other_columns, quoted, unboxed
from .textkern import Remembered, giving_back

CAPACITY = 2048
END_ID = 0
RANK_BUCKETS = 64  # buckets that share the ranking of one length
EFFORTS = (4000, 30, 100, 300, 1000, 10, 3)  # nodes of a completion search; its incumbent is valid at any time
TRIES = 24  # plans that are compared
SLICE_ROWS = 1024  # texts whose ids are held together; their words are those of the whole batch

_PIECE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class WordEncoder:
    """Token ids of texts by way of their distinct words.

    Punctuation after a letter or digit is a token run of its own, so ``word,``
    is looked up as ``word`` and ``,``; that keeps the number of distinct
    encodings near the vocabulary.
    """

    TAIL = ".,;:!?&%$*#"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Remembered()  # 32-bit ids

    def learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 4096):
            call = new[i:i + 4096]
            for w, e in zip(call, self.tokenizer.encode_batch_fast(call, add_special_tokens=False)):
                self.known.learn(w, array("I", e.ids).tobytes())

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of the distinct ``words``: of those that are remembered at once, of the others by their parts."""
        known = self.known
        out = list(map(known.get, words))
        plain, tailed = [], []
        for i, v in enumerate(out):
            if v is None:
                w = words[i]
                core = w.rstrip(self.TAIL)
                at = len(core)
                if at == len(w) or not at or not (w[at - 1].isalpha() or w[at - 1].isdecimal()):
                    plain.append(i)
                else:
                    tailed.append((i, core, w[at:]))
        parts = {words[i] for i in plain}
        parts.update(core for _, core, _ in tailed)
        parts.update({tail for _, _, tail in tailed})
        self.learn(known.unknown(parts))
        for i in plain:
            out[i] = known[words[i]]
        for i, core, tail in tailed:
            out[i] = known[core] + known[tail]
        known.settle()
        return out

    def encode(self, texts: pa.Array, rows: int = SLICE_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All ids (uint32), each text closed by the end id, and offsets, of ``rows`` texts at a time.

        Words are looked up once for all texts; the ids, which take most memory, are put together by slices."""
        flat = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(flat, " ")
        at = np.asarray(lists.offsets, np.int64)
        coded = lists.values.dictionary_encode()
        del flat, lists
        ids = self.ids_of(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), np.uint32)
        del ids
        first = np.cumsum(size) - size
        words = coded.indices.to_numpy(zero_copy_only=False)
        for lo in range(0, len(texts), rows):
            here = at[lo:lo + rows + 1]
            word = words[here[0]:here[-1]]
            # a word's ids, then one end id after the last word of each text
            counts = size[word]
            run = np.concatenate(([0], np.cumsum(counts)))
            offs = run[here - here[0]] + np.arange(len(here))
            out = np.empty(offs[-1], np.uint32)
            ends = np.zeros(offs[-1], bool)
            ends[offs[1:] - 1] = True
            out[ends] = END_ID
            out[~ends] = pool[np.repeat(first[word] - run[:-1], counts) + np.arange(run[-1])]
            yield out, offs


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """The encoder of a Python worker; the words it remembers are bounded by bytes, whatever the number of tasks."""
    return WordEncoder(path)


def pieces_of(path: str, capacity: int):
    """Arrow function: text -> its pieces (start, length, checksum of the ids)."""

    @F.arrow_udf(from_arrow_type(pa.list_(_PIECE)))
    @giving_back
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(path)
        for texts in batches:
            starts, lengths, sums, row_offs = [], [], [], [0]
            for ids, offs in encoder.encode(texts):
                raw = memoryview(ids.astype("<u4").tobytes())
                for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    for s in range(a, b, capacity):
                        e = min(b, s + capacity)
                        starts.append(s - a)
                        lengths.append(e - s)
                        sums.append(zlib.crc32(raw[4 * s:4 * e]))
                    row_offs.append(len(starts))
            flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, sums)],
                                              fields=list(_PIECE))
            yield pa.ListArray.from_arrays(pa.array(row_offs, pa.int32()), flat)

    return cut


def complete(room: int, lengths: list[int], left: list[int], nodes: int = EFFORTS[0]) -> list[tuple[int, int]]:
    """Filling of ``room`` as (index, copies): the best that a depth-first search of ``nodes`` nodes meets.

    ``lengths`` descend and ``left`` are their counts.  At each level the
    longest copies are tried first.  Dominated fillings are not left out; a
    branch is cut when even all that is left wastes no less than the incumbent.
    """
    n = len(lengths)
    # most that the lengths from i on can still add
    suffix = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        suffix[i] = min(room, suffix[i + 1] + lengths[i] * left[i])
    best: list[tuple[int, int]] = []
    best_waste = room + 1
    budget = nodes
    stack: list[tuple[int, int]] = []

    def search(i: int, free: int) -> bool:
        nonlocal best, best_waste, budget
        if free < best_waste:
            best, best_waste = list(stack), free
            if free == 0:
                return True
        budget -= 1
        if budget <= 0:
            return True
        lo, hi = i, n
        while lo < hi:  # first length that fits
            mid = (lo + hi) // 2
            if lengths[mid] <= free:
                hi = mid
            else:
                lo = mid + 1
        for j in range(lo, n):
            if free - suffix[j] >= best_waste:
                return False  # even all that is left wastes no less than the incumbent
            copies = min(left[j], free // lengths[j])
            for k in range(copies, 0, -1):
                stack.append((j, k))
                done = search(j + 1, free - k * lengths[j])
                stack.pop()
                if done:
                    return True
        return False

    search(0, room)
    return best


Plan = list[tuple[int, int, int, int, int, int]]


def plan_once(histogram: dict[int, int], capacity: int, effort: Callable[[], int]) -> tuple[int, Plan]:
    """Number of sequences and plan; ``effort`` gives the nodes of each completion search.

    Each step takes the longest length left, completes it, and repeats the
    filling while the counts of its lengths last, so each step uses some length
    up or spends a left-over of one; the number of steps follows the number of
    lengths, not of documents.
    """
    lengths = sorted((n for n in histogram if histogram[n] > 0), reverse=True)
    left = [histogram[n] for n in lengths]
    used = [0] * len(lengths)
    rows, sequence, top = [], 0, 0
    while top < len(lengths):
        if not left[top]:
            top += 1
            continue
        live = [i for i in range(top, len(lengths)) if left[i] - (i == top) > 0]
        room = capacity - lengths[top]
        filling = complete(room, [lengths[i] for i in live], [left[i] - (i == top) for i in live], effort())
        parts = {top: 1}
        for j, k in filling:
            parts[live[j]] = parts.get(live[j], 0) + k
        times = min(left[i] // k for i, k in parts.items())
        offset = 0
        for i in sorted(parts):
            k = parts[i]
            rows.append((lengths[i], used[i], times * k, k, sequence, offset))
            used[i] += times * k
            left[i] -= times * k
            offset += k * lengths[i]
        sequence += times
    return sequence, rows


def plan(histogram: dict[int, int], capacity: int = CAPACITY, tries: int = TRIES) -> Plan:
    """Rows (length, first rank, ranks, copies per sequence, first sequence, offset in it).

    A filling found with less effort wastes a little room but keeps short
    lengths for later, so several efforts are tried, uniform ones first and then
    mixed ones with fixed seeds.  The plan with the fewest sequences is kept; the
    search ends when no plan can have fewer.
    """
    least = -(-sum(n * k for n, k in histogram.items()) // capacity)
    best = None
    for t in range(tries):
        mixed = random.Random(t)
        uniform = EFFORTS[t] if t < len(EFFORTS) else None
        found = plan_once(histogram, capacity, lambda: uniform or mixed.choice(EFFORTS))
        if best is None or found[0] < best[0]:
            best = found
        if best[0] <= least:
            break
    return best[1]


class Places:
    """Place of the r-th piece of a length, by binary search in the plan (its size is bounded by the lengths)."""

    def __init__(self, rows: list[tuple[int, int, int, int, int, int]], stride: int):
        a = np.array(sorted((n * stride + first, copies, seq, off, first) for n, first, _, copies, seq, off in rows),
                     np.int64).reshape(-1, 5)
        self.stride, self.key, self.copies, self.seq, self.off, self.first = stride, *a.T

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, length * self.stride + rank, "right") - 1
        j = rank - self.first[k]
        return self.seq[k] + j // self.copies[k], self.off[k] + (j % self.copies[k]) * length


def best_fit_packing(docs: DataFrame, path: str, capacity: int = CAPACITY, text_col: str = "text") -> DataFrame:
    """One row for each piece: the other columns of ``docs`` plus piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    own, keep = other_columns(docs, *names, text_col), ["__own"]
    cut = docs.select(boxed(own), F.posexplode(pieces_of(path, capacity)(F.col(quoted(text_col)))).alias("piece", "__p"))
    # the bucket spreads even one frequent length; it is landed, so ranks refer to fixed rows
    bucket = F.pmod(F.xxhash64("ids_crc32", "start", F.monotonically_increasing_id()), F.lit(RANK_BUCKETS))
    pieces = landed(cut.select(*keep, "piece", "__p.*").withColumn("__bucket", bucket.cast("int"))
                    .withColumn("__row", F.monotonically_increasing_id()), "pieces")
    sizes = pieces.groupBy("length", "__bucket").count()
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity x RANK_BUCKETS rows
    sizes = landed(sizes.withColumn("__before", F.coalesce(F.sum("count").over(before), F.lit(0))), "ranks")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    stride = max([1, *histogram.values()]) + 1
    places = spark.sparkContext.broadcast(Places(plan(histogram, capacity), stride))

    place_t = pa.struct([("sequence_id", pa.int64()), ("offset", pa.int64())])

    @F.arrow_udf(from_arrow_type(place_t))
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        seq, off = places.value.of(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(seq, pa.int64()), pa.array(off, pa.int64())], fields=list(place_t))

    within = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("__row")) - 1
    ranked = pieces.withColumn("__within", within).join(sizes, ["length", "__bucket"])
    placed = ranked.withColumn("__at", place(F.col("length"), F.col("__before") + F.col("__within")))
    return placed.select(*unboxed(own), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "__at.*")


@register("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))
