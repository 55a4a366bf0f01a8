"""Hard negatives by threshold joins over pruned inverted indexes.

Components become whole numbers floor(256 x).  Rows equal in label and numbers
are one class, of which only the smallest ids can appear in a result.  Two joins
of the anchor classes with all classes follow, each dealt out to the cells of a
grid (``tiles.dealt``):

* positives: rows of the anchor's label; one window without limits;
* negatives: rows of other labels; one window of scores for each positive.

Inside a cell rows come in tiles.  A tile is indexed by dimension, strongest
dimensions first, in lists of a few dimensions at a time.  With a threshold t, a
row's last dimensions are left out of the index from the place where the norm of
what is left of it, times the largest such norm of an anchor, is below a share
RESERVE of t.  Partial scores are accumulated list by list; a row whose partial
scores plus remaining norms stay below the threshold of every anchor leaves, and
in the end every pair that does.  Surviving pairs are scored in full.

Thresholds start high and are lowered, for the anchors that need it, until their
windows hold enough rows or the lower ends of the windows are reached.  Later tiles of
a cell only look for rows better than the last of a full window.  What the cells
found is ranked once more over all cells.  Nothing is dropped by a cap: the
result is exact.

Rows with a null label, a null vector, or null or non-finite components take no
part; neither do rows with a null id, vectors without components, and vectors
whose numbers have squares that add up to 2**62 or more (a score could overflow).
Vectors of different lengths never meet.  Rows are rows: a repeated row is an
anchor or a partner of its own.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .nearest import classes_of, without_own
from .registry import register, table
from .shared import landed
from .tiles import cells, dealt, matrix, packed_vectors

EVERY = 50  # anchors: rows whose id is divisible by this
POSITIVES = 5
NEGATIVES = 3
SCALE = 256
LIST_DIMS = 8  # dimensions of one list of the index
RESERVE = 0.3  # share of the threshold that the dimensions left out may add up to
LEVELS = (0.7, 0.5, 0.35, 0.2)  # first thresholds, as shares of the span down to the windows' lower ends
ANCHORS = 2048  # anchors compared with a tile at once
LIMIT = 1 << 62  # sums of squares stay below, so a score is a long
EXACT = 1 << 52  # products of norms below which double precision is exact
NONE = -LIMIT - 1  # below every score


def whole_numbers(vectors: pa.Array) -> pa.Array:
    """Vectors as the bytes of 64-bit numbers floor(256 x); null for those that take no part."""
    clipped = packed_vectors(vectors, lambda x: np.clip(np.floor(x * SCALE), -(2.0**31), 2.0**31), zero=True)
    out = []
    for raw in clipped.to_pylist():
        x = None if raw is None else np.frombuffer(raw, np.float64)
        # a clipped component alone reaches the limit
        out.append(x.astype(np.int64).tobytes() if x is not None and (x * x).sum() < LIMIT else None)
    return pa.array(out, pa.binary())


class Rows:
    """Vectors with their dimensions in one order, and norms of what follows each list of dimensions."""

    def __init__(self, x: np.ndarray, order: np.ndarray):
        self.whole = x
        self.x = x[:, order].astype(np.float64)
        self.cuts = [*range(0, x.shape[1], LIST_DIMS), x.shape[1]]
        squares = np.concatenate([np.cumsum((self.x**2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))], axis=1)
        self.rest = np.sqrt(squares[:, self.cuts]) * (1 + 1e-12)  # rest[:, k]: norm from list k on

    def __len__(self) -> int:
        return len(self.x)


def reaching(q: Rows, who: np.ndarray, threshold: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs of anchors ``who`` with a score of their threshold or more."""
    lists = len(rows.cuts) - 1
    rest = q.rest[who]
    lowest = threshold.min()
    # lists in which a row is indexed: the first ones, up to the place where the rest is small
    if lowest > 0:
        indexed = (rows.rest * rest.max(axis=0) >= RESERVE * lowest).sum(axis=1)
        indexed = np.minimum(indexed, lists)
    else:
        indexed = np.full(len(rows), lists)
    order = np.argsort(-indexed, kind="stable")  # the rows of a list are then the first ones
    indexed = indexed[order]
    x, left = rows.x[order], rows.rest[order]
    partial = np.zeros((len(who), len(rows)))
    alive = np.ones(len(rows), bool)
    for k in range(lists):
        some = np.flatnonzero(alive[:np.searchsorted(-indexed, -k, "left")])
        if not len(some):
            break
        dims = slice(rows.cuts[k], rows.cuts[k + 1])
        add = q.x[who, dims] @ x[some, dims].T
        partial[:, some] += add
        if 2 * k in (lists, lists + 1):  # half-way: rows that can reach no anchor's threshold leave
            best = (partial[:, some] - threshold[:, None]).max(axis=0) + left[some, k + 1] * rest[:, k + 1].max()
            alive[some[best < -1e-9 * (left[some, 0] * rest[:, 0].max())]] = False
    end = np.minimum(indexed, lists)
    bound = partial + left[np.arange(len(rows)), end] * rest[:, end]
    bound += 1e-9 * left[:, 0] * rest[:, :1]
    i, j = np.nonzero((bound >= threshold[:, None]) & alive)
    j = order[j]
    score = np.empty(len(i), np.int64)
    exact = float(rest[:, 0].max(initial=0)) * float(rows.rest[:, 0].max(initial=0)) < EXACT
    a, b = (q.x, rows.x) if exact else (q.whole, rows.whole)
    step = max(1, (1 << 20) // q.x.shape[1])
    for lo in range(0, len(i), step):
        score[lo:lo + step] = (a[who[i[lo:lo + step]]] * b[j[lo:lo + step]]).sum(axis=1)
    keep = score >= threshold[i]
    return who[i[keep]], j[keep], score[keep]


class Windows:
    """For each anchor and window the best ``k`` classes so far, as arrays of scores, first ids and places."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k  # (anchors, windows); an unused window has low > high
        self.score = np.full((*low.shape, k), NONE, np.int64)
        self.first = np.full((*low.shape, k), np.iinfo(np.int64).max, np.int64)
        self.place = np.full((*low.shape, k), -1, np.int64)

    def full(self) -> np.ndarray:
        return (self.score[:, :, -1] > NONE) | (self.low > self.high)

    def needed(self) -> np.ndarray:
        """Least score that can still enter a window of an anchor."""
        last = np.where(self.low > self.high, LIMIT, np.maximum(self.low, self.score[:, :, -1]))
        return last.min(axis=1)

    def enter(self, i: np.ndarray, score: np.ndarray, first: np.ndarray, place: np.ndarray) -> None:
        for w in range(self.low.shape[1]):
            ok = (score >= self.low[i, w]) & (score <= self.high[i, w]) & (score >= self.score[i, w, -1])
            a, s, f, p = i[ok], score[ok], first[ok], place[ok]
            order = np.lexsort((f, -s, a))
            a, s, f, p = a[order], s[order], f[order], p[order]
            some = np.arange(len(a)) - np.searchsorted(a, a) < self.k  # of new ones only the k best can stay
            a, s, f, p = a[some], s[some], f[some], p[some]
            who = np.unique(a)
            if not len(who):
                continue
            at = np.searchsorted(who, a)
            slot = np.arange(len(a)) - np.searchsorted(a, a) + self.k
            both = [np.full((len(who), 2 * self.k), empty, np.int64) for empty in (NONE, np.iinfo(np.int64).max, -1)]
            for held, mine, new in zip(both, (self.score, self.first, self.place), (s, f, p)):
                held[:, :self.k] = mine[who, w]
                held[at, slot] = new
            ranked = np.lexsort((both[1], -both[0]), axis=-1)[:, :self.k]
            for held, mine in zip(both, (self.score, self.first, self.place)):
                mine[who, w] = np.take_along_axis(held, ranked, 1)


def least(windows: Windows, who: np.ndarray) -> np.ndarray:
    """Thresholds of the anchors as doubles, never above the whole numbers they stand for."""
    return np.nextafter(windows.needed()[who].astype(float), -np.inf)


def mine_cell(anchors: np.ndarray, labels: list | None, low: np.ndarray, high: np.ndarray, k: int,
              tiles: Iterator[tuple[np.ndarray, list, list, np.ndarray]]):
    """Fill the windows of a cell's anchors: (Windows, [(class, ids) by place]).

    ``tiles`` yields (vectors, labels, id lists, class numbers).  With ``labels``
    rows of an anchor's own label are left out.
    """
    windows, kept = Windows(low, high, k), {}
    order = q = None
    place = 0
    codes: dict = {}
    mine = None if labels is None else np.array([codes.setdefault(v, len(codes)) for v in labels])
    for x, theirs, ids, numbers in tiles:
        if q is None:
            # strongest dimensions first, by the first tile and the anchors
            order = np.argsort(-(np.square(x.astype(float)).sum(axis=0) * np.square(anchors.astype(float)).sum(axis=0)), kind="stable")
            q = Rows(anchors, order)
        rows = Rows(x, order)
        first = np.array([m[0] for m in ids])
        other = None if mine is None else np.array([codes.setdefault(v, len(codes)) for v in theirs])
        top = rows.rest[:, 0].max()
        for lo in range(0, len(q), ANCHORS):
            who = np.arange(lo, min(lo + ANCHORS, len(q)))
            floor = least(windows, who)
            # what a score can be at most: the windows' upper ends, or the product of the norms
            reach = q.rest[who, 0] * top
            upper = np.minimum(np.where(low[who] > high[who], NONE, high[who]).max(axis=1).astype(float), reach)
            seen = np.full(len(who), np.inf)  # scores from here on have entered
            todo = np.arange(len(who))
            for level in (*LEVELS, None):
                at = floor[todo]
                if level is not None:
                    start = np.maximum(at, -reach[todo])
                    at = np.where(windows.full()[who[todo]].all(axis=1), at, np.maximum(at, start + level * (upper[todo] - start)))
                at = np.ceil(at)
                i, j, score = reaching(q, who[todo], at, rows)
                ok = score < seen[i - lo]
                if mine is not None:
                    ok &= mine[i] != other[j]
                i, j, score = i[ok], j[ok], score[ok]
                windows.enter(i, score, first[j], place + j)
                seen[todo] = at
                floor = np.maximum(floor, least(windows, who))
                # lower where a window is not full and its lower end is not reached
                todo = todo[np.ceil(floor[todo]) < at]
                if not len(todo):
                    break
        for p in np.unique(windows.place[windows.place >= place]).tolist():
            kept[p] = (int(numbers[p - place]), ids[p - place])
        place += len(rows)
    return windows, kept


def threshold_join(grid: DataFrame, group: list[str], k: int, other_labels: bool) -> DataFrame:
    """(q, tag, score, id, cls, rank): the ``k`` best rows of each anchor class and window, over all its cells.

    The anchors have arrays tag, low and high, an entry for each window.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, tiles in cells(batches, group):
            tags, lows, highs = (held.column(c).to_pylist() for c in ("tag", "low", "high"))
            width = max(map(len, lows))
            low = np.array([[*v, *[1] * (width - len(v))] for v in lows], np.int64)
            high = np.array([[*v, *[0] * (width - len(v))] for v in highs], np.int64)
            windows, kept = mine_cell(
                matrix(held.column("x").chunk(0), np.int64), held.column("label").to_pylist() if other_labels else None,
                low, high, k, ((matrix(t.column("x"), np.int64), t.column("label").to_pylist(), t.column("ids").to_pylist(),
                                t.column("cls").to_numpy()) for t in tiles))
            numbers = held.column("cls").to_pylist()
            out = []
            for a, w in zip(*(v.tolist() for v in np.nonzero(windows.place[:, :, 0] >= 0))):
                found = [(int(s), i, kept[p][0]) for s, p in zip(windows.score[a, w], windows.place[a, w].tolist()) if p >= 0
                         for i in kept[p][1]]
                found.sort(key=lambda r: (-r[0], r[1], r[2]))
                out += [(numbers[a], tags[a][w], *f) for f in found[:k]]
            yield pa.record_batch([pa.array([o[c] for o in out], pa.int64()) for c in range(5)],
                                  names=["q", "tag", "score", "id", "cls"])

    found = grid.mapInArrow(mine, "q long, tag long, score long, id long, cls long")
    order = Window.partitionBy("q", "tag").orderBy(F.desc("score"), "id", "cls")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""

    @F.arrow_udf("binary")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            yield whole_numbers(v)

    rows = landed(vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        whole(F.col(vec_col).cast("array<double>")).alias("x")).filter(
        "id is not null and label is not null and x is not null"), "negatives-vectors")
    anchor = F.col("id") % every == 0
    known = classes_of(rows, ["label", "x"], max(positives + 1, negatives), anchor, "negatives-classes")
    known = known.select("cls", "label", "x", "ids", "wanted", F.octet_length("x").alias("dim"))
    asked, all_of = known.filter("wanted").select("cls", "label", "x", "dim"), known.drop("wanted")

    # positives: the anchor's own row is among its class's best, so one more is looked for
    whole_range = asked.select("*", *(F.array(F.lit(v).cast("long")).alias(c) for c, v in (
        ("tag", 0), ("low", -LIMIT), ("high", LIMIT))))
    best = threshold_join(dealt(whole_range, all_of, ["label", "dim"], "cls", "positives"), ["label", "dim"], positives + 1, False)
    best = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "cls", "score"))).alias("best"))
    best = landed(best.join(asked.select(F.col("cls").alias("q"), "label", "x"), "q"), "positives")
    mine = rows.filter(anchor).join(best, ["label", "x"]).select(
        F.col("id").alias("anchor_id"), "q", F.slice(without_own("best", "id", "q"), 1, positives).alias("best"))
    pairs = landed(mine.select("anchor_id", "q", F.explode("best").alias("hit")).select(
        "anchor_id", "q", F.col("hit.id").alias("positive_id"), F.col("hit.score").alias("positive_score")), "positive-pairs")

    # negatives: a window for each score that a positive of the class has; below zero windows are empty
    windows = pairs.filter("positive_score >= 0").select("q", F.col("positive_score").alias("tag")).distinct().select(
        "q", "tag", F.expr("tag div 2 + tag % 2").alias("low"),
        F.expr("tag - tag div 20 - if(tag % 20 > 0, 1, 0)").alias("high")).filter("low <= high")
    windows = windows.groupBy(F.col("q").alias("cls")).agg(F.sort_array(F.collect_list(F.struct("tag", "low", "high"))).alias("w"))
    seekers = landed(asked.join(windows, "cls").select(*asked.columns, "w.tag", "w.low", "w.high"), "seekers")
    found = threshold_join(dealt(seekers, all_of, ["dim"], "cls", "negatives"), ["dim"], negatives, True)
    return pairs.join(found.withColumnRenamed("tag", "positive_score"), ["q", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


@register("op13_hard_negatives")
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))
