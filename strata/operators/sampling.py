"""Reproducible sampling and splits from a hash of a unique key.

Every row's fate depends only on ``md5(key)``, so sampling is a narrow filter
(no shuffle, no global sort, identical in any engine that has md5).  Where a
*count* must be exact (a cap, ``n`` rows, a per-class share), the hash value
at the boundary rank is found with the bounded exact selection of
``functions.stats`` and the rows are then filtered against it.  Only rows that
tie exactly at the boundary (same 52-bit hash prefix) are numbered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.stats import values_at_ranks
from ..session import scratch_path

HEX_DIGITS = 8
MAX_CLASSES = 1000  # classes of a ``by`` column; each is a condition of the plan
NULL_CLASS = "null"


def key_md5(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def hex_threshold(fraction: float, digits: int = HEX_DIGITS) -> str:
    """Lower-case hex string t with P(substr(md5, 1, digits) < t) = floor(fraction * 16^digits) / 16^digits."""
    v = max(0, min(16 ** digits, math.floor(fraction * 16 ** digits)))
    return "g" * digits if v >= 16 ** digits else format(v, f"0{digits}x")


def in_fraction(key: str, fraction: float, digits: int = HEX_DIGITS) -> Column:
    return F.substring(key_md5(key), 1, digits) < F.lit(hex_threshold(fraction, digits))


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    return df.where(in_fraction(key, fraction))


def _h52(key: str) -> Column:
    # 13 hex digits = 52 bits: exact in a double, so the selection can rank it.
    return F.conv(F.substring(key_md5(key), 1, 13), 16, 10).cast("double")


def class_name(col: str) -> Column:
    """Text of a class label; null is a class of its own (no text equals it)."""
    return F.when(F.col(col).isNull(), NULL_CLASS).otherwise(F.concat(F.lit("="), F.col(col).cast("string")))


def class_sizes(df: DataFrame, col: str) -> dict[str, int]:
    """Rows of each class; fails early when the column is no class label."""
    rows = df.groupBy(class_name(col).alias("name")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{col} has more than {MAX_CLASSES} classes")
    return {r["name"]: r["n"] for r in rows}


def flag_first_by_hash(df: DataFrame, key: str, n, by: str | None = None, flag: str = "_in") -> DataFrame:
    """Adds boolean ``flag``: row is among the ``n`` smallest ``md5(key)`` (per ``by``
    group when given; then ``n`` may be a dict {class_name: n}).  ``by`` is a class
    label with few values: one boundary per class is planned.

    One narrow comparison against the boundary hash of each group; rows that
    tie exactly at a boundary (duplicated keys) are told apart by number."""
    h = df.withColumn("_h", _h52(key))
    name = class_name(by) if by else F.lit("all")
    long = h.select(name.alias("name"), F.col("_h").alias("value"))
    if by:
        class_sizes(df, by)
    stats = {r["name"]: (r["n"], r["lo"], r["hi"]) for r in long.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    sizes = {g: v[0] for g, v in stats.items()}
    want = {g: (n.get(g, 0) if isinstance(n, dict) else n) for g in sizes}
    # a null key has no hash: its rows come last
    ranks = {g: [want[g] - 1] for g, size in sizes.items() if 0 < want[g] < size}
    bound = values_at_ranks(long.where(F.col("value").isNotNull()), ranks, initial=stats) if ranks else {}
    cond = F.lit(False)
    ties: dict = {}
    for g, size in sizes.items():
        if want[g] >= size:
            cond = cond | (name == g)
        elif want[g] > 0:
            t = bound[g][want[g] - 1]
            cond = cond | ((name == g) & (F.col("_h") < t))
            ties[g] = (name == g) & (F.col("_h") == t)
    if not ranks:
        return h.withColumn(flag, cond).drop("_h")
    # One aggregate: rows below each boundary and rows tied at it.
    counts = h.agg(*[e for i, g in enumerate(ranks) for e in (
        F.count_if((name == g) & cond).alias(f"b{i}"), F.count_if(ties[g]).alias(f"t{i}"))]).first()
    partial = {}
    for i, g in enumerate(ranks):
        need = want[g] - counts[f"b{i}"]
        if need >= counts[f"t{i}"]:
            cond = cond | ties[g]          # the whole tie is taken (the usual case: one boundary row)
        elif need > 0:
            partial[g] = need              # only part of a tie (duplicated keys): number its rows
    if not partial:
        return h.withColumn(flag, cond).drop("_h")
    tie_any = F.lit(False)
    for g in partial:
        tie_any = tie_any | ties[g]
    plain = h.where(~tie_any).withColumn(flag, cond).drop("_h")
    return plain.unionByName(_flag_ties(h.where(tie_any).drop("_h"), name, partial, flag))


def _flag_ties(tied: DataFrame, name: Column, need: dict, flag: str) -> DataFrame:
    """Flag ``need[group]`` of the rows that tie at a group's hash boundary.

    The tied rows are numbered where they lie and landed in the shared folder, so
    the numbers are the same however often a task runs.  The boundary number of
    each group comes from the same histogram rounds; every row stays a row of its
    own, so one key with a third of all rows is spread over as many tasks."""
    spark = tied.sparkSession
    path = scratch_path(spark, "ties")
    numbered = tied.withColumn("_rid", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    # 2**53 numbers are exact in a double: partition number << 33, plus the place in it
    long = numbered.select(name.alias("name"), F.col("_rid").cast("double").alias("value"))
    bound = values_at_ranks(long, {g: [v - 1] for g, v in need.items()})
    take = F.lit(False)
    for g, v in need.items():
        take = take | ((name == g) & (F.col("_rid").cast("double") <= bound[g][v - 1]))
    return numbered.withColumn(flag, take).drop("_rid")


def first_by_hash(df: DataFrame, key: str, n, by: str | None = None) -> DataFrame:
    """The ``n`` rows with the smallest ``md5(key)`` (per group with ``by``)."""
    return flag_first_by_hash(df, key, n, by, "_in").where("_in").drop("_in")


def sample_fraction_capped(df: DataFrame, key: str, fraction: float = 0.05, cap: int | None = None) -> DataFrame:
    """``fraction`` of the rows by hash; with ``cap`` at most that many (the smallest hashes)."""
    s = hash_sample(df, key, fraction)
    return s if cap is None else first_by_hash(s, key, cap)


def sample_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly min(n, rows) rows, chosen by hash."""
    return first_by_hash(df, key, n)


def split_by_hash(df: DataFrame, key: str, test_fraction: float = 0.2) -> DataFrame:
    """Adds ``is_test``: about ``test_fraction`` of rows, narrow."""
    return df.withColumn("is_test", in_fraction(key, test_fraction))


def split_stratified(df: DataFrame, key: str, label: str, test_fraction: float = 0.2) -> DataFrame:
    """Adds ``is_test``: exactly ceil(test_fraction * n_c) rows of each class c; rows
    with a null label are a class of their own."""
    want = {g: math.ceil(test_fraction * c) for g, c in class_sizes(df, label).items()}
    return flag_first_by_hash(df, key, want, by=label, flag="is_test")


def concat_samples(frames: list[DataFrame], key: str, fraction: float, cap: int | None) -> DataFrame:
    """Union of per-input hash samples, then one cap over the union."""
    out = None
    for f in frames:
        s = hash_sample(f, key, fraction)
        out = s if out is None else out.unionByName(s)
    return out if cap is None else first_by_hash(out, key, cap)


def head_preview(df: DataFrame, n: int, *order_by) -> DataFrame:
    """First ``n`` rows in an explicit key order (Spark row order is otherwise undefined)."""
    return df.orderBy(*order_by).limit(n)
