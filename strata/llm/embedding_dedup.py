"""Embedding near-dedup by cross-polytope hashing.

Vectors are compared only under equal labels.  Equal vectors of a label are one
class, hashed and compared once.  Each class is hashed in TABLES tables: a
random rotation (three rounds of random signs and a fast Hadamard transform,
after padding to a power of two), then the signed axis closest to the rotated
vector, for PARTS independent rotations a table.  Multiprobe: besides its own
bucket a vector enters the buckets of its next-closest axes, so a pair meets when
any of its entries agree.

Buckets are dealt out by (label, table, bucket); one with more than BLOCK
entries in pairs of blocks, so a hot bucket is many tasks.  Candidate pairs of a
bucket are verified in blocks of a matrix product in double precision.  A pair
that meets in several buckets is counted in the first of them only, which both
vectors' signatures tell without another shuffle.  A bucket yields link counts
for its classes and a spanning forest of its links, never the pairs.

Vectors that are null, zero or hold null or non-finite components, or whose
label is null, link with nothing.  Repeated rows are vectors of their own.  A
null id takes no part in the smallest id of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import register, table
from .shared import boxed, components, landed, other_columns, quoted, unboxed

MIN_COSINE = 0.93
TABLES = 12
PARTS = 2  # rotations hashed together in a table
PROBES = 4  # buckets each vector enters in a table, its own included
BLOCK = 2048  # entries of a bucket that are compared in one group
SEED = 20240229


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length is a power of two)."""
    n = x.shape[1]
    h = 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def signatures(unit: np.ndarray, tables: int = TABLES, parts: int = PARTS, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers, shape (rows, tables, probes); the first probe is the vector's own bucket.

    Probes are the cheapest changes: the axes of all parts are ranked by how
    much closer the best axis is than theirs, summed over the parts changed.
    """
    rows, dim = unit.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((rows, size))
    padded[:, :dim] = unit
    out = np.empty((rows, tables, probes), np.int64)
    rng = np.random.default_rng([SEED, size])
    for t in range(tables):
        axis, gap = [], []
        for _ in range(parts):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            # the closest axes: largest absolute components, with their signs
            k = min(probes, size)
            top = np.argpartition(-np.abs(y), k - 1, axis=1)[:, :k]
            val = np.take_along_axis(y, top, 1)
            order = np.argsort(-np.abs(val), axis=1, kind="stable")
            top, val = np.take_along_axis(top, order, 1), np.take_along_axis(val, order, 1)
            axis.append(2 * top + (val < 0))
            gap.append(np.abs(val[:, :1]) - np.abs(val))
        # all combinations of the closest axes, cheapest first
        code, cost = axis[0], gap[0]
        for a, g in zip(axis[1:], gap[1:]):
            code = (code[:, :, None] * (2 * size) + a[:, None, :]).reshape(rows, -1)
            cost = (cost[:, :, None] + g[:, None, :]).reshape(rows, -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t, :best.shape[1]] = np.take_along_axis(code, best, 1)
        out[:, t, best.shape[1]:] = out[:, t, :1]
    return out


def usable(vectors: pa.Array) -> pa.Array:
    """Vectors as bytes of doubles; null where they link with nothing."""
    out = []
    for v in vectors:
        x = None if not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        ok = x is not None and len(x) and v.values.null_count == 0 and np.isfinite(x).all() and x.any()
        out.append(x.tobytes() if ok else None)
    return pa.array(out, pa.binary())


def rows_of(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def links_of(ids: np.ndarray, weights: np.ndarray, block: np.ndarray, unit: np.ndarray, sig: np.ndarray, at: int,
             bucket: int, cross: bool, min_cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of one bucket (``bucket`` of table ``at``): links of each class counted here, and a spanning forest.

    With ``cross`` only pairs from different blocks are looked at.
    """
    n = len(ids)
    counts = np.zeros(n, np.int64)
    group = np.arange(n)
    forest = []
    for lo in range(0, n, 512):
        near = unit[lo:lo + 512] @ unit.T >= min_cosine
        i, j = np.nonzero(near)
        i += lo
        keep = i < j
        if cross:
            keep &= block[i] != block[j]
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        # met before: an earlier table, or an earlier bucket of this table, holds both
        met = np.zeros(len(i), bool)
        for t in range(at + 1):
            a, b = sig[i, t], sig[j, t]
            same = a[:, :, None] == b[:, None, :]
            if t == at:
                same &= (a < bucket)[:, :, None]
            met |= same.any(axis=(1, 2))
        i, j = i[~met], j[~met]
        np.add.at(counts, i, weights[j])
        np.add.at(counts, j, weights[i])
        for a, b in zip(i.tolist(), j.tolist()):
            if group[a] != group[b]:
                forest.append((int(ids[a]), int(ids[b])))
                group[group == group[b]] = group[a]
    return counts, forest


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, tables: int = TABLES, parts: int = PARTS,
                    probes: int = PROBES, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """``vectors`` without the vector column, plus n_links, component_id and kept."""
    own = other_columns(vectors, vec_col, "n_links", "component_id", "kept")
    vectors = vectors.select(boxed(own), *(F.col(quoted(c)).alias(f"__{n}") for c, n in (
        (id_col, "id"), (vec_col, "vector"), (label_col, "label"))))

    @F.arrow_udf("binary")
    def doubles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for v in batches:
            yield usable(v)

    x = F.when(F.col("__label").isNotNull(), doubles(F.col("__vector").cast("array<double>")))
    rows = landed(vectors.select("__own", "__id", F.monotonically_increasing_id().alias("__row"), "__label", x.alias("__x")), "vectors")

    # classes of equal vectors; a length is part of the value, so vectors of other lengths never meet
    classes = landed(rows.filter("__x is not null").groupBy("__label", "__x").agg(
        F.min("__row").alias("cls"), F.count("*").alias("w")), "vector-classes")

    @F.arrow_udf("array<array<long>>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for raw in batches:
            raw = raw.to_pylist()
            out: list = [None] * len(raw)
            for size in {len(r) for r in raw}:
                some = [k for k, r in enumerate(raw) if len(r) == size]
                for lo in range(0, len(some), 4096):
                    part = some[lo:lo + 4096]
                    got = signatures(unit_rows(rows_of([raw[k] for k in part])), tables, parts, probes)
                    for k, s in zip(part, got):
                        out[k] = s.tolist()
            yield pa.array(out, pa.list_(pa.list_(pa.int64())))

    signed = landed(classes.withColumn("sig", hashes(F.col("__x"))).withColumn("dim", F.octet_length("__x")), "signed")
    entries = signed.select("cls", "__label", "dim", F.posexplode("sig").alias("t", "b")).select(
        "cls", "__label", "dim", "t", F.explode(F.array_distinct("b")).alias("bucket"))
    where = ["__label", "dim", "t", "bucket"]
    sizes = entries.groupBy(*where).agg(F.count("*").alias("n")).filter("n > 1")
    sizes = landed(sizes.withColumn("nb", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")).drop("n"), "bucket-sizes")
    dealt = entries.join(sizes, where).withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.select(*where, F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "cls")
    group = [*where, "i", "j"]
    sent = dealt.join(signed.select("cls", "w", "__x", F.flatten("sig").alias("sig")), "cls").select(
        *group, "blk", "cls", "w", "__x", "sig").repartition(*group).sortWithinPartitions(*group, "cls")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["u", "v", "n"]

        def emit(key, held):
            if len(held) < 2:
                return
            ids = np.array([h[1] for h in held])
            sig = np.array([h[4] for h in held], np.int64).reshape(len(held), tables, probes)
            counts, forest = links_of(ids, np.array([h[2] for h in held]), np.array([h[0] for h in held]),
                                      unit_rows(rows_of([h[3] for h in held])), sig, key[2], key[3], key[4] != key[5],
                                      min_cosine)
            some = np.flatnonzero(counts)
            # a link of the forest has two ends, a count one
            yield pa.record_batch([pa.array([*ids[some].tolist(), *(a for a, _ in forest)], pa.int64()),
                                   pa.array([*[None] * len(some), *(b for _, b in forest)], pa.int64()),
                                   pa.array([*counts[some].tolist(), *[0] * len(forest)], pa.int64())], names=names)

        key, held = None, []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(11)]
            for row in zip(*cols):
                if row[:6] != key:
                    yield from emit(key, held)
                    key, held = row[:6], []
                held.append(row[6:])
        yield from emit(key, held)

    found = landed(sent.mapInArrow(verify, "u long, v long, n long"), "vector-links")
    totals = found.filter("v is null").groupBy(F.col("u").alias("cls")).agg(F.sum("n").alias("others"))
    root = components(found.filter("v is not null").select("u", "v"))

    known = classes.join(totals, "cls", "left").join(root.withColumnRenamed("node", "cls"), "cls", "left")
    known = known.select("__label", "__x", "cls", "w", F.coalesce("root", "cls").alias("root"),
                         F.coalesce("others", F.lit(0)).alias("others"))
    placed = rows.join(known, ["__label", "__x"], "left").withColumn("root", F.coalesce("root", "__row"))
    placed = landed(placed.drop("__x", "__label"), "vectors-placed")
    least = landed(placed.groupBy("root").agg(F.min("__id").cast(T.LongType()).alias("component_id")), "vector-roots")
    out = placed.join(least, "root")
    n_links = F.when(F.col("cls").isNull(), 0).otherwise(F.col("others") + F.col("w") - 1).cast("long")
    return out.select(*unboxed(own), n_links.alias("n_links"), "component_id",
                      F.coalesce(F.col("__id") == F.col("component_id"), F.lit(False)).alias("kept"))


@register("op7_embedding_dedup")
def op7_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")
