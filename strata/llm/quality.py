"""Quality rules: fixed base rules, then a calibrated hashed n-gram classifier.

Base features are counted over whole Arrow batches with numpy.  The verdict for
rows that pass the base rules comes from two logistic regressions (quality and
toxicity) over hashed word and character n-grams:

* features: frequencies of word 1- and 2-grams and of byte 5-grams, hashed
  into 2**BITS buckets each.  A text's margin is the bias plus the mean weight of its
  grams of each family, so scoring is one gather and needs no sort;
* fit: at most ``FIT_ROWS`` labelled rows, shared out over the combinations of the
  two labels as evenly as their counts allow; of each combination those with the
  smallest hash of their id (a fixed choice, not a prefix).  Many tasks hash their
  texts into sparse rows, which are landed; the regressions add up gradients over
  tasks (``LogisticRegression`` with a penalty on absolute weights, which leaves most
  buckets at zero).  No text and no row passes the driver, only the weights do, and
  their number is fixed.  The two weight tables are broadcast;
* calibration: a Platt curve fitted on the fifth of the rows that the weights
  never saw, each row weighed by how many labelled rows it stands for, so the
  probabilities are those of the table; thresholds are fixed probabilities.

Every row of ``documents`` is scored on its whole text.  Null text has no words
and fails the base rules.  Rows keep their own results when repeated; labels
that are null or that have no document are not used.  With too few labels of a
class the classifier abstains and the base rules decide alone.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, landed, other_columns, quoted, unboxed
from .textkern import IS_SPACE, LOWER, Words, blocks, giving_back, mix, window_hashes

FIT_ROWS = 5000  # bound on labelled rows used to fit
BITS = 18  # buckets of each family: 2**BITS
MIN_QUALITY = 0.5  # kept needs P(good) of this or more
MAX_TOXIC = 0.5  # and P(toxic) below this
MIN_ROWS = 5  # rows of the fit that a bucket must occur in,
MIN_SHARE = 0.003  # and share of them
HEADS = ("quality", "toxic")
PENALTY = 0.01  # on absolute weights, of buckets scaled to the same spread
STEPS = 15  # of the solver, at most
FIT_TASKS = 64  # tasks that hash the rows of the fit
SUM_TASKS = 4  # tasks that add up gradients: each sends one of fixed size, so few of them
FILE_ROWS = 64  # hashed rows of a landed file: a row has as many entries as its text has different grams
HELD = 5  # of so many rows of the fit one is kept for calibration
MIN_CLASS = 5  # rows of each class a head needs to be fitted

# Fixed values of the base rules.
MIN_WORDS = 20
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
CHAR_GRAMS = (5,)

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    cum = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return cum[offs[1:]] - cum[offs[:-1]]


def duplicate_lines(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text (bytes compared)."""
    n = len(offs) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = data == 10
    ends[offs] = True  # texts begin lines too
    cut = np.flatnonzero(ends)
    cut = np.append(cut[cut < len(data)], len(data))
    row = np.searchsorted(offs, cut[:-1], "right") - 1
    word = np.concatenate(([0], np.cumsum(~IS_SPACE[data])))
    solid = word[cut[1:]] > word[cut[:-1]]
    # drop the line ends, so that a last line equals the same line elsewhere
    keep = data != 10
    kept = np.concatenate(([0], np.cumsum(keep)))
    lines = pa.Array.from_buffers(pa.large_binary(), len(cut) - 1,
                                  [None, pa.py_buffer(kept[cut].astype(np.int64)), pa.py_buffer(data[keep])])
    ids = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    pair = np.stack([row[solid], ids[solid].astype(np.int64)], axis=1)
    first = np.unique(pair[:, 0] * (len(cut) + 1) + pair[:, 1]) // (len(cut) + 1)
    return np.bincount(pair[:, 0], minlength=n) - np.bincount(first, minlength=n)


def repeated_words(h: np.ndarray, offs: np.ndarray, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur twice or more in the text."""
    out = np.zeros(len(offs) - 1, np.int64)
    w = window_hashes(h, size)
    for i, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
        m = b - a - size + 1
        if m < 2:
            continue
        mine = w[a:a + m]
        order = np.argsort(mine, kind="stable")
        same = mine[order][1:] == mine[order][:-1]
        if not same.any():
            continue
        twice = np.zeros(m, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(b - a + 1, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + size, -1)
        out[i] = np.count_nonzero(np.cumsum(edge[:-1]))
    return out


def base_features(data: np.ndarray, offs: np.ndarray, words: Words, h: np.ndarray) -> np.ndarray:
    points = ~IS_SPACE[data] & ((data & 0xC0) != 0x80)
    return np.stack([
        np.diff(words.offs), _per_text(points, offs), _per_text(_IS_SYMBOL[data], offs), duplicate_lines(data, offs),
        repeated_words(h, words.offs)], axis=1)


def grams(data: np.ndarray, offs: np.ndarray, h: np.ndarray, woffs: np.ndarray):
    """Buckets of each family with per-text bounds: word 1-grams, word 2-grams, byte grams.

    A gram that would cross into the next text counts for neither: the offsets end before it.
    """
    shift = np.uint64(64 - BITS)
    yield (mix(h) >> shift).astype(np.int64), woffs[:-1], woffs[1:]
    two = (window_hashes(h, 2) >> shift).astype(np.int64)
    yield two, woffs[:-1], np.maximum(woffs[:-1], woffs[1:] - 1)
    low = LOWER[data].astype(np.uint64)
    for size in CHAR_GRAMS:
        run = np.zeros(max(0, len(low) - size + 1), np.uint64)
        for j in range(size):
            run *= np.uint64(0x100000001B3)
            run += low[j:j + len(run)]
        run *= np.uint64(0x9E3779B97F4A7C15)
        run ^= run >> np.uint64(29)
        run *= np.uint64(0xBF58476D1CE4E5B9)
        yield (run >> shift).astype(np.int64), offs[:-1], np.maximum(offs[:-1], offs[1:] - size + 1)


FAMILIES = 2 + len(CHAR_GRAMS)


class Scorer:
    """Two calibrated heads over the weight table of FAMILIES x 2**BITS entries each."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, platt: np.ndarray, fitted: np.ndarray):
        self.weights, self.bias, self.platt, self.fitted = weights, bias, platt, fitted

    def margins(self, data, offs, h, woffs) -> np.ndarray:
        out = np.tile(self.bias, (len(offs) - 1, 1)).astype(np.float64)
        for k, (bucket, lo, hi) in enumerate(grams(data, offs, h, woffs)):
            n = np.maximum(hi - lo, 1)
            lo, hi = np.minimum(lo, len(bucket)), np.minimum(hi, len(bucket))
            for c in range(2):
                cum = np.concatenate(([0.0], np.cumsum(self.weights[c, k][bucket], dtype=np.float64)))
                out[:, c] += (cum[hi] - cum[lo]) / n
        return out

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(margins * self.platt[:, 0] + self.platt[:, 1], -50, 50)))
        p[:, ~self.fitted] = np.array([1.0, 0.0])[~self.fitted]  # a head without a fit abstains
        return p


def hashed_rows(texts: pa.Array) -> pa.StructArray:
    """Sparse feature rows: gaps between the ascending ids in FAMILIES x 2**BITS, counts, and the grams of each family.

    Gaps and counts are small numbers, which Parquet packs well.
    """
    out = []
    for text in texts.to_pylist():
        data = np.frombuffer((text or "").encode(), np.uint8)
        offs = np.array([0, len(data)])
        words = Words(data, offs, lower=True)
        ids, counts, totals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for k, (bucket, lo, hi) in enumerate(grams(data, offs, words.hashes(), words.offs)):
            n = max(0, min(int(hi[0]), len(bucket)) - int(lo[0]))
            totals.append(n)
            u, c = np.unique(bucket[lo[0]:lo[0] + n], return_counts=True)
            ids.append(u + (k << BITS))
            counts.append(c)
        out.append((np.diff(np.concatenate(ids), prepend=0).astype(np.int32), np.concatenate(counts).astype(np.int32), totals))
    return pa.StructArray.from_arrays([pa.array([o[c] for o in out], f.type) for c, f in enumerate(_HASHED)], fields=list(_HASHED))


_HASHED = pa.struct([("gaps", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("totals", pa.list_(pa.int64()))])


@giving_back
def bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rows of the task that have it), from batches of gaps."""
    seen = np.zeros(FAMILIES << BITS, np.int64)
    for batch in batches:
        for gaps in batch.column(0):
            seen[np.cumsum(gaps.values.to_numpy())] += 1
    some = np.flatnonzero(seen)
    yield pa.record_batch([pa.array(some, pa.int64()), pa.array(seen[some], pa.int64())], names=["id", "n"])


def _platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y | margin), by damped Newton steps on smoothed targets."""
    weight = weight / weight.mean()
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (weight * (p - t)) + 1e-3 * (b - [1.0, 0.0]))
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def assemble(heads: list) -> Scorer:
    """Scorer of the quality and the toxicity head; a head that is None abstains."""
    weights = np.zeros((2, FAMILIES, 1 << BITS), np.float32)
    bias, platt, fitted = np.zeros(2), np.tile([1.0, 0.0], (2, 1)), np.zeros(2, bool)
    for c, head in enumerate(heads):
        if head is not None:
            weights[c], bias[c], platt[c], fitted[c] = head[0], head[1], head[2:], True
    return Scorer(weights, bias, platt, fitted)


def shares(counts: dict, total: int) -> dict:
    """``total`` shared out as evenly as the counts allow; whole numbers, never above a count."""
    out, left = {}, total
    for k, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], repr(x[0])))):
        out[name] = min(n, left // (len(counts) - k))
        left -= out[name]
    return out


def chosen_rows(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame | None:
    """(doc_id, quality, toxic, weight, held, text) of at most ``fit_rows`` labelled documents; None if there is no label."""
    chosen = labels.select("doc_id", "quality", "toxic").filter(
        "doc_id is not null and (quality is not null or toxic is not null)")
    chosen = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = landed(chosen.select("doc_id", (F.col("quality") > 0).alias("quality"), (F.col("toxic") > 0).alias("toxic")),
                    "labels")
    # at most nine combinations of two labels that may be null
    counts = {(r["quality"], r["toxic"]): r["count"] for r in chosen.groupBy("quality", "toxic").count().collect()}
    quota = shares(counts, fit_rows)
    rank = F.xxhash64("doc_id")
    parts = [
        # the smallest hashes are ids spread evenly over the table
        chosen.filter(F.col("quality").eqNullSafe(F.lit(q)) & F.col("toxic").eqNullSafe(F.lit(t)))
        .orderBy(rank, "doc_id").limit(n).withColumn("weight", F.lit(counts[(q, t)] / n))
        for (q, t), n in sorted(quota.items(), key=repr) if n]
    if not parts:
        return None
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        functools.reduce(DataFrame.union, parts), "doc_id")
    heads = [F.max(F.col(h).cast("double")).alias(h) for h in HEADS]
    # of rows that share an id the smallest text counts
    rows = rows.groupBy("doc_id").agg(*heads, F.max("weight").alias("weight"), F.min("text").alias("text"))
    return rows.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD)) == 0)


def fit_head(rows: DataFrame, head: str, known: np.ndarray):
    """(weight table, bias, slope, offset) of one head; None with too few rows of a class.

    ``rows`` has the labels, weight, held and the sparse vectors ``x`` over the buckets ``known``.
    """
    mine = rows.filter(F.col(head).isNotNull())
    counts = {(r["held"], r[head]): r["count"] for r in mine.groupBy("held", head).count().collect()}
    enough = {held: min(counts.get((held, y), 0) for y in (0.0, 1.0)) >= MIN_CLASS for held in (False, True)}
    if not enough[False] or not len(known):
        return None
    # the classes weigh the same in total
    total = sum(counts[(False, y)] for y in (0.0, 1.0))
    balance = F.when(F.col(head) > 0, total / (2 * counts[(False, 1.0)])).otherwise(total / (2 * counts[(False, 0.0)]))
    model = LogisticRegression(
        featuresCol="x", labelCol=head, weightCol="balance", regParam=PENALTY, elasticNetParam=1.0, maxIter=STEPS,
        standardization=True).fit(mine.filter(~F.col("held")).withColumn("balance", balance).coalesce(SUM_TASKS))
    table_ = np.zeros(FAMILIES << BITS, np.float32)
    table_[known] = model.coefficients.toArray()
    # one number for each row held back, so as many as the bound on rows at most
    calm = model.transform(mine.filter("held") if enough[True] else mine.filter(~F.col("held"))).select(
        vector_to_array("rawPrediction")[1].alias("margin"), F.col(head).alias("y"), "weight").toPandas()
    platt = _platt(calm.margin.to_numpy(), calm.y.to_numpy(), calm.weight.to_numpy())
    return table_.reshape(FAMILIES, -1), float(model.intercept), *platt


def fit_scorer(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Scorer:
    """Fit on at most ``fit_rows`` labelled rows, hashed and added up by many tasks."""
    chosen = chosen_rows(docs, labels, fit_rows)
    if chosen is None:
        return assemble([None, None])

    @F.arrow_udf(from_arrow_type(_HASHED))
    @giving_back
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield hashed_rows(texts)

    rows = landed(chosen.repartition(FIT_TASKS).select(*HEADS, "weight", "held", hashed("text").alias("g")), "quality-rows", FILE_ROWS)
    # fixed in number: FAMILIES << BITS buckets at most
    fitted = rows.filter(~F.col("held"))
    least = max(MIN_ROWS, MIN_SHARE * fitted.count())
    seen = fitted.select("g.gaps").mapInArrow(bucket_rows, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    known = np.sort(seen.filter(F.col("n") >= least).select("id").toPandas()["id"].to_numpy(np.int64))
    place = np.full(FAMILIES << BITS, -1, np.int32)
    place[known] = np.arange(len(known), dtype=np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(place)

    @F.udf(VectorUDT())
    def vector(gaps, counts, totals):
        ids = np.cumsum(np.array(gaps, np.int64))
        at = shared.value[ids]
        freq = np.array(counts) / np.array(totals)[ids >> BITS]
        return Vectors.sparse(max(1, len(known)), at[at >= 0], freq[at >= 0])

    # both heads read the vectors more than once; they are made again from the landed rows where an executor is lost
    rows = rows.select(*HEADS, "weight", "held", vector("g.gaps", "g.counts", "g.totals").alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return assemble([fit_head(rows, head, known) for head in HEADS])
    finally:
        rows.unpersist()


_FIELDS = pa.struct([*((c, pa.int64()) for c in BASE), ("p_quality", pa.float64()), ("p_toxic", pa.float64())])


def features_of(texts: pa.Array, scorer: Scorer) -> pa.StructArray:
    parts = []
    for _, data, offs in blocks(texts):
        plain = Words(data, offs)
        h = plain.hashes()
        base = base_features(data, offs, plain, h)
        p = scorer.probabilities(scorer.margins(data, offs, plain.hashes(lower=True), plain.offs))
        parts.append(np.concatenate([base, p], axis=1))
    got = np.concatenate(parts) if parts else np.zeros((0, len(BASE) + 2))
    return pa.StructArray.from_arrays(
        [pa.array(got[:, i].astype(np.int64)) for i in range(len(BASE))]
        + [pa.array(got[:, len(BASE)]), pa.array(got[:, len(BASE) + 1])], fields=list(_FIELDS))


def quality_rules(docs: DataFrame, labels: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` with the base features, base_failed, p_quality, p_toxic and kept; clashing names are replaced."""
    model = docs.sparkSession.sparkContext.broadcast(
        fit_scorer(docs.select("doc_id", F.col(quoted(text_col)).alias("text")), labels, fit_rows))

    @F.arrow_udf(from_arrow_type(_FIELDS))
    @giving_back
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield features_of(texts, model.value)

    names = [*BASE, "p_quality", "p_toxic"]
    own = other_columns(docs, *names, "base_failed", "kept")
    scored = docs.select(boxed(own), score(F.col(quoted(text_col))).alias("__q")).select(
        *unboxed(own), *[F.col(f"__q.{c}") for c in names])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_quality") >= MIN_QUALITY) & (F.col("p_toxic") < MAX_TOXIC))


@register("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", *BASE, "base_failed", "kept", "p_quality", "p_toxic")
