"""Nearest neighbours by inner product: a block matrix join on int8 tiles.

1. Equal vectors are one class, compared once; of its ids only the k + 1
   smallest can be among anyone's k nearest (ties go to the smaller id), so only
   these are kept, however many there are.
2. Query classes meet all classes in the cells of a grid (``tiles.dealt``).
   Vectors are quantised to int8 with a scale of their own; a tile of products
   is one matrix product of codes, exact in its integers.  With x = s c + e,
   |<q, x> - s_q s_x <c_q, c_x>| <= |q| |e_x| + |e_q| |s_x c_x|, so each product
   comes with an interval that holds the true one.
3. A pair survives when the upper end of its interval reaches the query's bound:
   the (k + 1)-th best lower end of the first tile, later the (k + 1)-th best true
   product so far.  Survivors are recomputed in double precision and go through a
   heap of k + 1 classes for each query; heaps of a query's cells are merged the
   same way.  No pair within reach of the bound is dropped, so the result is exact.

Vectors that are null, empty, zero or hold null or non-finite components take no
part, and neither do rows with a null id.  Vectors of different lengths never
meet.  Rows are rows: a repeated row is a candidate (and a query) of its own, and a
query leaves out one row with its id and vector.  Products that overflow count
as infinite, undefined ones as minus infinity.  Other columns of the input are
not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import register, table
from .shared import landed
from .tiles import SIDE, cells, dealt, matrix, packed_vectors

K = 20
EVERY = 20  # queries: rows whose id is divisible by this
EXACT_DIMS = 1024  # dims whose products of codes (127 * 127 at most) add up exactly in single precision
SLACK = 1e-9  # of |q| |x|: more than the rounding of bounds and products


class Quantised:
    """int8 codes of the rows of ``x`` (held as floats for the matrix product), scales, norms and errors."""

    def __init__(self, x: np.ndarray):
        self.x = x
        top = np.abs(x).max(axis=1)
        self.scale = top / 127
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            # tiny scales underflow: such rows get codes of zero and their whole norm as error
            codes = np.where(self.scale[:, None] > 0, np.rint(x / np.where(self.scale > 0, self.scale, 1)[:, None]), 0)
            self.codes = codes.astype(np.int8).astype(np.float32)
            near = self.scale[:, None] * codes
            self.error = _norms(x - near)
            self.near = _norms(near)
            self.norm = _norms(x)

    def __len__(self) -> int:
        return len(self.x)


def _norms(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1)
    safe = np.where(top > 0, top, 1)
    return safe * np.sqrt(((x / safe[:, None]) ** 2).sum(axis=1)) * (1 + 1e-12)


def intervals(q: Quantised, lo: int, hi: int, c: Quantised) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the products of queries ``lo`` to ``hi`` with all of ``c``, and their error bounds."""
    a, dims = q.codes[lo:hi], q.codes.shape[1]
    if dims <= EXACT_DIMS:
        product = (a @ c.codes.T).astype(np.float64)
    else:
        product = np.zeros((hi - lo, len(c)))
        for d in range(0, dims, EXACT_DIMS):
            product += a[:, d:d + EXACT_DIMS] @ c.codes[:, d:d + EXACT_DIMS].T
    with np.errstate(over="ignore", invalid="ignore"):
        product *= q.scale[lo:hi, None]
        product *= c.scale
        bound = q.norm[lo:hi, None] * (c.error + SLACK * c.norm)
        bound += q.error[lo:hi, None] * c.near
        unsure = ~np.isfinite(product + bound)
        product[unsure], bound[unsure] = 0, np.inf
    return product, bound


def true_products(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    step = max(1, (1 << 20) // q.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):
        for lo in range(0, len(i), step):
            out[lo:lo + step] = (q[i[lo:lo + step]] * c[j[lo:lo + step]]).sum(axis=1)
    return np.where(np.isnan(out), -np.inf, out)


def offer(heap: list, item: tuple, k: int) -> None:
    """Keep the ``k`` largest items."""
    if len(heap) < k:
        heapq.heappush(heap, item)
    elif item > heap[0]:
        heapq.heapreplace(heap, item)


def best_of_cell(queries: np.ndarray, tiles: Iterator[tuple[np.ndarray, np.ndarray, list]], k: int) -> list[list]:
    """For each query a heap of its ``k`` best classes: (product, -first id, class, ids).

    ``tiles`` yields (vectors, class numbers, id lists, smallest first).
    """
    q = Quantised(queries)
    heaps: list[list] = [[] for _ in range(len(q))]
    bound = np.full(len(q), -np.inf)
    for x, numbers, ids in tiles:
        c = Quantised(x)
        first = np.array([m[0] for m in ids])
        for lo in range(0, len(q), SIDE):
            hi = min(lo + SIDE, len(q))
            near, err = intervals(q, lo, hi, c)
            reach = bound[lo:hi]
            if len(c) >= k and not np.isfinite(reach).all():
                lower = np.partition(near - err, len(c) - k, axis=1)[:, len(c) - k]
                reach = np.maximum(reach, lower)
            i, j = np.nonzero(near + err >= reach[:, None])
            score = true_products(q.x, c.x, i + lo, j)
            # of a tile only the k best of each query can stay
            keep = score >= bound[lo:hi][i]
            i, j, score = i[keep], j[keep], score[keep]
            order = np.lexsort((first[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            some = np.flatnonzero(rank < k)
            for a, b, s in zip((i[some] + lo).tolist(), j[some].tolist(), score[some].tolist()):
                offer(heaps[a], (s, -ids[b][0], int(numbers[b]), ids[b]), k)
            for a in np.unique(i[some]).tolist():
                if len(heaps[a + lo]) == k:
                    bound[a + lo] = heaps[a + lo][0][0]
    return heaps


def top_rows(heap: list, k: int) -> list[tuple[float, int, int]]:
    """The ``k`` best rows of a heap of classes: (product, id, class), best first."""
    rows = [(s, i, c) for s, _, c, ids in heap for i in ids]
    return sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[:k]


def classes_of(rows: DataFrame, same: list[str], members: int, wanted: Column, name: str) -> DataFrame:
    """Rows equal in ``same`` as one: cls, ids (the ``members`` smallest, sorted), wanted (whether it holds for one)."""
    order = Window.partitionBy(*same).orderBy("id")
    least = rows.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= members)
    least = least.groupBy(*same).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    any_of = rows.groupBy(*same).agg(F.max(wanted).alias("wanted"))
    return landed(least.join(any_of, same).withColumn("cls", F.monotonically_increasing_id()), name)


def without_own(best: str, own_id: str, own_cls: str) -> Column:
    """Array ``best`` of (score, id, cls) without one entry of the row's own."""
    at = F.array_position(F.transform(best, lambda e: (e["id"] == F.col(own_id)) & (e["cls"] == F.col(own_cls))), True)
    return F.filter(best, lambda e, k: k + 1 != at)


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each row whose id is divisible by ``every``."""
    element = vectors.schema[vec_col].dataType.elementType
    dtype = np.float32 if isinstance(element, T.FloatType) else np.float64

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            yield packed_vectors(v, dtype=dtype)

    rows = landed(vectors.select(F.col(id_col).cast("long").alias("id"), packed(F.col(vec_col).cast(
        T.ArrayType(T.FloatType() if dtype == np.float32 else T.DoubleType()))).alias("x")).filter(
        "id is not null and x is not null"), "nearest-vectors")
    known = classes_of(rows, ["x"], k + 1, F.col("id") % every == 0, "nearest-classes").withColumn("dim", F.octet_length("x"))
    asked = known.filter("wanted").select("dim", "cls", "x")
    grid = dealt(asked, known.select("dim", "cls", "x", "ids"), ["dim"], "cls", "nearest")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, tiles in cells(batches, ["dim"]):
            heaps = best_of_cell(
                matrix(held.column("x").chunk(0), dtype).astype(np.float64),
                ((matrix(t.column("x"), dtype).astype(np.float64), t.column("cls").to_numpy(), t.column("ids").to_pylist())
                 for t in tiles), k + 1)
            numbers = held.column("cls").to_pylist()
            out = [(q, *item) for q, heap in zip(numbers, heaps) for item in heap]
            yield pa.record_batch([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.float64()),
                pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.list_(pa.int64()))],
                names=["q", "score", "cls", "ids"])

    found = grid.mapInArrow(search, "q long, score double, cls long, ids array<long>").repartition("q").sortWithinPartitions("q")
    entry = pa.struct([("score", pa.float64()), ("id", pa.int64()), ("cls", pa.int64())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(q, heap):
            rows = [{"score": s, "id": i, "cls": c} for s, i, c in top_rows(heap, k + 1)]
            return pa.record_batch([pa.array([q], pa.int64()), pa.array([rows], pa.list_(entry))], names=["q", "best"])

        now, heap = None, []
        for batch in batches:
            for q, s, c, ids in zip(*(batch.column(n).to_pylist() for n in ("q", "score", "cls", "ids"))):
                if q != now:
                    if now is not None:
                        yield done(now, heap)
                    now, heap = q, []
                offer(heap, (s, -ids[0], c, ids), k + 1)
        if now is not None:
            yield done(now, heap)

    best = found.mapInArrow(merge, "q long, best array<struct<score: double, id: long, cls: long>>")
    answers = landed(best.join(known.select(F.col("cls").alias("q"), "x"), "q"), "nearest-answers")
    out = rows.filter(F.col("id") % every == 0).join(answers, "x").select(
        F.col("id").alias("query_id"), F.slice(without_own("best", "id", "q"), 1, k).alias("best"))
    return out.select("query_id", F.posexplode("best").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"),
        F.col("hit.score").alias("score"))


@register("op11_nearest")
def op11_nearest(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"))
