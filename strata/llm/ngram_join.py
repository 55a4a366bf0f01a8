"""N-gram Jaccard join by multiple-global-order filtering.

Texts whose word-shingle sets have a Jaccard similarity of ``percent``/100 or
more are linked; the result is the connected component of every text.  The
filter is exact: two sets this similar share k or more tokens in their *prefixes*
(the first n - ceil(t n) + k tokens) under **every** global order of the tokens.
``k`` is a twentieth of the smaller set, at least one.

* Orders.  All put tokens of unusually full hash buckets last (a table of
  2**BUCKET_BITS counts over all texts, whose size does not depend on the data)
  and differ in the hash that ranks the others.
* Texts.  Under the first order, a text needs as many prefix tokens that other
  texts have as it would share with its smallest possible partner.  Texts that
  only have a passage in common with others do not get past this.
* Candidates.  Under the first order, each prefix token of a size class points to
  the smallest text that has it, its pivot (grouped min, combined map-side).  All
  texts with a token are candidates of the token's pivot, so any pair that shares
  a token, and is close enough in size, meets in a pivot's group.  The join is on
  tokens, never on all pairs.
* Verification.  A group gets its texts.  Only texts not yet known
  to be connected are compared; a pair must pass the size bound and share prefix
  tokens under every order before its intersection is counted.  Groups larger
  than ``BLOCK`` are dealt out in pairs of blocks, so a hot pivot is many tasks.
* Each group yields a spanning forest of its links, not the links; components
  are joined up by Spark.

Texts with the same set form one class and are compared once.  A text without
words has no shingle and is linked with nothing.  Null text counts as empty.
Repeated rows keep their own row; null ids do not take part in the smallest id
of a component (null where all are null).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .registry import register, table
from .shared import boxed, components, landed, other_columns, quoted, text_digest, unboxed
from .textkern import giving_back, mix, shingle_sets

BUCKET_BITS = 20
PARTS = 64  # pieces in which the table of counts travels
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)  # salts of the orders
BLOCK = 2048  # texts of a pivot that are compared in one group


def bucket_levels(docs: DataFrame, text: str, words: int) -> np.ndarray:
    """Per hash bucket 0, or how far its count exceeds what an even spread explains."""
    size = 1 << BUCKET_BITS

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size, np.int64), False
        for batch in batches:
            held, n = [], 0
            for s in shingle_sets(batch.column(0), words):
                held.append(s)
                n += len(s)
                if n > 1 << 20:
                    total += np.bincount(np.concatenate(held) & np.uint64(size - 1), minlength=size)
                    held, n = [], 0
            if held:
                total += np.bincount(np.concatenate(held) & np.uint64(size - 1), minlength=size)
            some = True
        if some:
            parts = np.split(total, PARTS)
            yield pa.record_batch([pa.array(range(PARTS), pa.int32()),
                                   pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
                                  names=["part", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size // PARTS, np.int64)
        for c in pdf.counts:
            total += np.frombuffer(zlib.decompress(c), np.int64)
        return pd.DataFrame({"part": pdf.part.iloc[:1], "counts": [total.tobytes()]})

    parts = docs.select(text).mapInArrow(count, "part int, counts binary")
    got = parts.groupBy("part").applyInPandas(add, "part int, counts binary").collect()
    total = np.zeros(size, np.int64)
    for r in got:
        total[r["part"] * (size // PARTS):][:size // PARTS] = np.frombuffer(r["counts"], np.int64)
    even = total.mean() + 3 * np.sqrt(total.mean()) + 1
    over = np.maximum(total / even, 1)
    return np.minimum(np.ceil(4 * np.log2(over)), 255).astype(np.uint8)


def order_keys(tokens: np.ndarray, levels: np.ndarray, salt: int) -> np.ndarray:
    """Rank keys of tokens in one global order."""
    level = levels[tokens & np.uint64(len(levels) - 1)].astype(np.uint64)
    return (level << np.uint64(56)) | (mix(tokens ^ np.uint64(salt)) >> np.uint64(8))


def shared_least(n):
    """k: tokens that two linked sets share in their prefixes, from the size of the smaller one."""
    return np.maximum(1, n // 20)


def partner_least(n: int, percent: int) -> int:
    """Size of the smallest set that can be linked to one of size ``n``."""
    return (n * percent + 99) // 100


def prefix(tokens: np.ndarray, levels: np.ndarray, salt: int, percent: int) -> np.ndarray:
    """Tokens of the prefix of a set."""
    n = len(tokens)
    p = n - partner_least(n, percent) + int(shared_least(n))
    if len(tokens) == 0 or p >= len(tokens):
        return tokens
    return tokens[np.argpartition(order_keys(tokens, levels, salt), p - 1)[:p]]


_SKETCH = pa.struct([("n", pa.int64()), ("need", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.list_(pa.int64()))])


def sketch(texts: pa.Array, words: int, percent: int, levels: np.ndarray) -> pa.StructArray:
    """Set size, shared tokens it needs, 128-bit identity of the set, prefix under the first order."""
    n, need, s1, s2, parts, offs = [], [], [], [], [], [0]
    for s in shingle_sets(texts, words):
        n.append(len(s))
        need.append(int(shared_least(partner_least(len(s), percent))))
        s1.append(int(mix(s ^ np.uint64(ORDERS[1])).sum(dtype=np.uint64).astype(np.int64)))
        s2.append(int(mix(s ^ np.uint64(ORDERS[2])).sum(dtype=np.uint64).astype(np.int64)))
        p = prefix(s, levels, ORDERS[0], percent)
        parts.append(p)
        offs.append(offs[-1] + len(p))
    flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(need, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
         pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(flat))], fields=list(_SKETCH))


def _shares(offs: np.ndarray, tokens: np.ndarray, mine: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per row of ``rows``: how many of its tokens occur in the sorted ``mine``."""
    lens = offs[rows + 1] - offs[rows]
    at = np.repeat(offs[rows] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
    some = tokens[at]
    k = np.searchsorted(mine, some)
    hit = mine[np.minimum(k, len(mine) - 1)] == some
    cum = np.concatenate(([0], np.cumsum(hit)))
    ends = np.cumsum(lens)
    return cum[ends] - cum[ends - lens]


def forest(sets: list[np.ndarray], levels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that span the components of the group's similarity graph."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sets = [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    csr = lambda parts: (np.concatenate(([0], np.cumsum([len(p) for p in parts]))), np.concatenate(parts))
    full = csr(sets)
    filters = []
    for salt in ORDERS:
        parts = [prefix(s, levels, salt, percent) for s in sets]
        filters.append(csr([np.sort(p) for p in parts]))
    group = np.arange(len(sets))
    least = shared_least(sizes)
    links = []
    for q in range(len(sets)):
        # sizes ascend: partners after q are not smaller, and at most 100/percent as large
        hi = int(np.searchsorted(sizes, sizes[q] * 100 // percent, "right"))
        rows = np.arange(q + 1, hi)
        rows = rows[group[rows] != group[q]]
        for offs, tokens in filters:
            if len(rows):
                rows = rows[_shares(offs, tokens, tokens[offs[q]:offs[q + 1]], rows) >= least[q]]
        if not len(rows):
            continue
        both = _shares(*full, sets[q], rows)
        rows = rows[100 * both >= percent * (sizes[q] + sizes[rows] - both)]
        for r in rows.tolist():
            if group[r] != group[q]:
                group[group == group[r]] = group[q]
                links.append((order[q], order[r]))
    return links


def ngram_components(docs: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text",
                     id_col: str = "doc_id") -> DataFrame:
    """``docs`` without its text, plus n_shingles and component_id.

    ``__key`` (digest of id and text) and ``__root`` (number of the component) serve later joins.
    """
    spark = docs.sparkSession
    own, keep = other_columns(docs, text_col, "n_shingles", "component_id", "__key", "__root"), ["__own", "__id"]
    keyed = docs.select(boxed(own), F.col(quoted(id_col)).alias("__id"), F.col(quoted(text_col)).alias("__t"),
                        text_digest(id_col, text_col).alias("__key"))
    text_col = "__t"
    levels = spark.sparkContext.broadcast(bucket_levels(keyed, text_col, words))

    @F.arrow_udf(from_arrow_type(_SKETCH))
    @giving_back
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield sketch(texts, words, percent, levels.value)

    rows = landed(keyed.select(*keep, "__key", F.monotonically_increasing_id().alias("__row"),
                               sketches(F.col(text_col)).alias("s")).select(*keep, "__key", "__row", "s.*"), "sketches")

    # texts with the same set are one class, named by its smallest row
    classes = landed(rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("__row").alias("cls")), "sets")
    of_row = landed(rows.select("__row", "s1", "s2").join(classes, ["s1", "s2"]).select("__row", "cls"), "classes")

    # sizes of linked sets differ by a factor of at most 100/percent, so by at most one class of sizes
    ratio = math.log(100 / percent) + 1e-9
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio)).cast("int")
    tokens = rows.select("__row", level.alias("lv"), "need", F.explode("prefix").alias("tok"))
    again = tokens.groupBy("tok").agg(F.min("__row").alias("lo"), F.max("__row").alias("hi")).filter("lo < hi").select("tok")
    again = landed(again, "tokens")  # so that the join has exchanges of its own and a frequent token can be split
    hits = landed(tokens.join(again, "tok"), "repeated-tokens")

    def met(some: DataFrame) -> DataFrame:
        """Tokens with the pivot of their size class, where two texts or more have them."""
        sized = some.select("tok", "__row", "need", F.explode(F.array(F.col("lv"), F.col("lv") + 1)).alias("lv"))
        pivots = sized.groupBy("tok", "lv").agg(F.min("__row").alias("pivot"), F.max("__row").alias("hi"))
        return sized.join(landed(pivots.filter("pivot < hi").drop("hi"), "pivots"), ["tok", "lv"])

    def enough(some: DataFrame) -> DataFrame:
        """Hits of the texts that have as many tokens in ``some`` as they need."""
        alive = some.groupBy("__row").agg(F.countDistinct("tok").alias("k"), F.max("need").alias("need"))
        alive = landed(alive.filter("k >= need").select("__row"), "alive")
        return landed(hits.join(alive, "__row", "left_semi"), "hits")

    hits = enough(hits)
    hits = enough(met(hits))  # texts that are gone, or of another size, no longer count
    star = met(hits).filter("__row <> pivot").select("pivot", "__row").distinct()
    star = star.join(of_row, "__row").select("pivot", F.col("cls").alias("m"))
    star = star.join(of_row.select(F.col("__row").alias("pivot"), F.col("cls").alias("p")), "pivot").select("p", "m")
    star = landed(star.filter("p <> m").distinct(), "candidates")

    # groups: the pivot and its candidates, in pairs of blocks where there are many
    members = star.union(star.select("p", F.col("p").alias("m")).distinct())
    sizes = star.groupBy("p").agg(F.ceil((F.count("*") + 1) / F.lit(BLOCK)).cast("int").alias("nb"))
    dealt = members.join(sizes, "p").withColumn("b", F.pmod(F.xxhash64("m"), F.col("nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")
    dealt = dealt.select("p", "m", "b", other).select(
        "m", F.struct("p", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j")).alias("g"))
    wanted = dealt.groupBy("m").agg(F.collect_list("g").alias("groups"))
    wanted = wanted.join(rows.select(F.col("__row").alias("m"), "__key"), "m")

    # the text travels, not its set: it is smaller than eight bytes for each word
    sent = keyed.select("__key", text_col).join(wanted, "__key").select(
        "m", F.col(text_col).alias("text"), F.explode("groups").alias("g"))
    sent = sent.select("g.*", "m", "text").repartition("p", "i", "j").sortWithinPartitions("p", "i", "j", "m")

    @giving_back
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(ids, group):
            pairs = forest(group, levels.value, percent) if len(ids) > 1 else []
            return [(ids[a], ids[b]) for a, b in pairs]

        key, ids, group, out = None, [], [], []
        for batch in batches:
            p, i, j, m = (batch.column(k).to_pylist() for k in range(4))
            for k, s in enumerate(shingle_sets(batch.column(4), words)):
                if (p[k], i[k], j[k]) != key:
                    out += linked(ids, group)
                    key, ids, group = (p[k], i[k], j[k]), [], []
                if not ids or ids[-1] != m[k]:  # a repeated row is there once
                    ids.append(m[k])
                    group.append(s)
            if out:
                yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()),
                                       pa.array([x[1] for x in out], pa.int64())], names=["u", "v"])
                out = []
        out = linked(ids, group)
        if out:
            yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())],
                                  names=["u", "v"])

    links = landed(sent.mapInArrow(verify, "u long, v long"), "links")
    root = components(links)

    placed = rows.select(*keep, "__key", "__row", F.col("n").alias("n_shingles")).join(of_row, "__row", "left")
    placed = placed.join(root.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls", "__row"))
    placed = landed(placed.drop("cls", "__row"), "placed")
    least = landed(placed.groupBy("root").agg(F.min("__id").alias("component_id")), "roots")
    return placed.join(least, "root").select(*unboxed(own), "n_shingles", "component_id", "__key", F.col("root").alias("__root"))


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text",
                      id_col: str = "doc_id") -> DataFrame:
    """``docs`` reduced to one row of each component: smallest id, then smallest text digest; null ids come last.

    Rows equal in id and text count as one.
    """
    found = ngram_components(docs.select(quoted(id_col), quoted(text_col)), words, percent, text_col, id_col)
    mine = F.col(quoted(id_col))
    best = found.groupBy("__root").agg(F.min(F.struct(mine.isNull(), mine, "__key")).alias("best"))
    chosen = best.select(F.col("best.__key").alias("__key")).distinct()
    keyed = docs.select(boxed(docs.columns), text_digest(id_col, text_col).alias("__key"))
    return keyed.join(chosen, "__key", "left_semi").dropDuplicates(["__key"]).select(*unboxed(docs.columns))


@register("op4_ngram_join")
def op4_ngram_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_components(docs, words=4, percent=85).drop("__key", "__root")
