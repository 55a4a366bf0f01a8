"""Aggregate helpers that stay exact and bounded at any scale.

``exact_quantiles`` answers order statistics without ever holding a whole
column in one task or the driver.  Doubles are mapped to 64-bit whole numbers of
the same order, and a radix selection counts ten bits of them a pass (in each
task over Arrow batches, then over tasks), for all columns and ranks at once: at
most seven passes, however the values are spread.  The driver sees a fixed number of buckets a pass,
and nothing depends on the number of shuffle partitions.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def stable_dec6(c: Column) -> Column:
    """Double -> DECIMAL(18,6) with a tiny offset so two engines that sum in a
    different order still round exact ties the same way (compare-only)."""
    return (c + F.lit(0.000000013).cast("double")).cast("decimal(18,6)")


BUCKETS = 1024  # histogram buckets of one open window: ten bits


def ordered_key(v: Column) -> Column:
    """64-bit whole number in the order of the doubles (no NaN): the bits of the absolute value, mirrored below zero."""
    size = F.abs(v)
    # the exponent; the logarithm may be off by one next to a power of two
    near = F.floor(F.log2(F.greatest(size, F.lit(2.0**-1022)))).cast("int")
    near = F.greatest(F.lit(-1022), F.least(F.lit(1023), near))
    low = F.when(F.pow(F.lit(2.0), near) > size, near - 1).otherwise(near)
    high = F.when((low < 1023) & (F.pow(F.lit(2.0), F.least(low + 1, F.lit(1023))) <= size), low + 1).otherwise(low)
    exponent = F.greatest(F.lit(-1022), high)
    plain = ((exponent + 1023).cast("long") * F.lit(1 << 52)
             + ((size / F.pow(F.lit(2.0), exponent) - 1.0) * F.lit(2.0**52)).cast("long"))
    tiny = (size * F.lit(2.0**1022) * F.lit(2.0**52)).cast("long")
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size < 2.0**-1022, tiny).otherwise(plain)
    return F.when(v < 0, -bits - 1).otherwise(bits)


def key_of(v: float) -> int:
    """``ordered_key`` of a number at hand."""
    bits = struct.unpack(">q", struct.pack(">d", abs(v)))[0]
    return -bits - 1 if v < 0 else bits


def shift_of(lo: float, hi: float, buckets: int) -> int:
    """Bits that stay below the bucket number in a window, so that it has about ``buckets`` buckets at most."""
    return max(0, (key_of(hi) - key_of(lo)).bit_length() - (buckets.bit_length() - 1))


def _counts_of(windows: list[tuple], buckets: int, wide: bool):
    """Arrow function of a task's part of ``_histogram``: its rows -> (w, b, n, lo, hi), one row a filled bucket.

    Windows of one name do not overlap, so a value's window is found by binary search."""
    plans = {}
    for name in {n for n, _, _ in windows}:
        mine = sorted((lo, hi, i) for i, (n, lo, hi) in enumerate(windows) if n == name)
        shifts = [shift_of(lo, hi, buckets) for lo, hi, _ in mine]
        first = [key_of(lo) >> s for (lo, _, _), s in zip(mine, shifts)]
        sizes = [(key_of(hi) >> s) - f + 1 for (_, hi, _), s, f in zip(mine, shifts, first)]
        plans[name] = (*(np.array(x) for x in zip(*mine)), np.array(shifts), np.array(first), np.cumsum([0, *sizes]))

    def add(held, name, values):
        lows, highs, ids, shifts, first, offsets = plans[name]
        at = np.searchsorted(lows, values, "right") - 1
        inside = (at >= 0) & (values <= highs[at])  # not of a NaN
        at, values = at[inside], values[inside]
        if not len(values):
            return
        if name not in held:
            size = offsets[-1]
            held[name] = np.zeros(size, np.int64), np.full(size, np.inf), np.full(size, -np.inf)
        n, lo, hi = held[name]
        bits = np.abs(values).view(np.int64)
        slot = offsets[at] + (np.where(values < 0, -bits - 1, bits) >> shifts[at]) - first[at]
        n += np.bincount(slot, minlength=len(n))
        np.minimum.at(lo, slot, values)
        np.maximum.at(hi, slot, values)

    def run(batches):
        held = {}
        for batch in batches:
            if wide:
                for name in plans:
                    add(held, name, batch.column(name).to_numpy(zero_copy_only=False))
                continue
            values = batch.column("value").to_numpy(zero_copy_only=False)
            names = batch.column("name").dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(names.dictionary.to_pylist()):
                if name in plans:
                    add(held, name, values[code == k])
        for name, (n, lo, hi) in held.items():
            _, _, ids, _, first, offsets = plans[name]
            slot = np.flatnonzero(n)
            at = np.searchsorted(offsets, slot, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                ids[at].astype(np.int32), slot - offsets[at] + first[at], n[slot], lo[slot], hi[slot])], ["w", "b", "n", "lo", "hi"])

    return run


def _histogram(df: DataFrame, windows: list[tuple], buckets: int, wide: bool = False) -> list:
    """Counts and value ranges of the buckets of each window (name, lo, hi): one pass
    over the rows, added up within tasks and then over them.  ``df`` holds (name, value)
    pairs or, if ``wide``, a column of doubles for each name.  The result has at most
    len(windows) * buckets rows, whatever the size of the data."""
    some = df.select(*(F.col(f"`{n}`") for n in sorted({n for n, _, _ in windows}))) if wide else df.select("name", "value")
    rows = some.mapInArrow(_counts_of(windows, buckets, wide), "w int, b bigint, n bigint, lo double, hi double")
    return (rows.groupBy("w", "b").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .orderBy("w", "b").collect())


def values_at_ranks(long_df: DataFrame, wanted: dict[str, list[int]], buckets: int = BUCKETS,
                    initial: dict | None = None, wide: bool = False) -> dict[str, dict[int, float]]:
    """Exact value at each 0-based rank (ascending) per name of a (name, value) frame;
    if ``wide``, of a frame with a column of doubles for each name (needs ``initial``).

    Every (name, rank) target has an open value window and the exact count of
    values below it, at first the whole column.  A round counts the values of the
    open windows by histogram bucket and keeps, for each target, the bucket that
    holds its rank; a bucket with one value answers it.  Rows outside the windows
    are dropped before the count.  Buckets share the leading bits of their keys, so
    a round settles ten bits of them, and leading bits that a window's ends share
    cost none.  ``initial`` = {name: (rows, min, max)} from
    the caller saves the first pass."""
    if initial is None:
        initial = {r["name"]: (r["n"], r["lo"], r["hi"]) for r in long_df.groupBy("name").agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
    out: dict[str, dict[int, float]] = {n: {} for n in wanted}
    todo: dict[tuple, tuple] = {}  # target -> (lo, hi, values below lo)
    for n, ranks in wanted.items():
        for r in set(ranks):
            rows, lo, hi = initial.get(n, (0, None, None))
            if not 0 <= r < rows:
                raise ValueError(f"rank {r} of {n!r}, which has {rows} values")
            todo[(n, r)] = (lo, hi, 0)
    while todo:
        for t in [t for t, (lo, hi, _) in todo.items() if lo == hi]:
            out[t[0]][t[1]] = todo.pop(t)[0]
        if not todo:
            break
        windows = sorted({(n, lo, hi) for (n, _), (lo, hi, _) in todo.items()}, key=repr)
        found: dict[int, list] = {}
        for row in _histogram(long_df, windows, buckets, wide):
            found.setdefault(row["w"], []).append(row)
        for t, (lo, hi, below) in list(todo.items()):
            for row in found[windows.index((t[0], lo, hi))]:
                if below + row["n"] > t[1]:
                    todo[t] = (row["lo"], row["hi"], below)
                    break
                below += row["n"]
    return out


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], **kw) -> dict[str, list]:
    """Linear-interpolated quantiles (numpy / pandas / ``quantile_cont``), exact.

    NaN and null are skipped.  Returns ``{col: [q(p) for p in probs]}`` (None for an empty column).
    """
    # columns stay side by side: one row of the input is one row of every pass
    wide_df = df.select(*(F.col(c).cast("double").alias(f"q{i}") for i, c in enumerate(cols)))
    some = [F.when(~F.isnan(q), F.col(q)) for q in wide_df.columns]
    row = wide_df.agg(*(f(v).alias(f"{k}{i}") for i, v in enumerate(some) for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max)))).first() if cols else None
    stats = {c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}
    n_by = {k: v[0] for k, v in stats.items()}
    wanted, plan = {}, {}
    for c in cols:
        n = n_by.get(c, 0)
        plan[c] = []
        ranks = set()
        for p in probs:
            if n == 0:
                plan[c].append(None)
                continue
            h = (n - 1) * p
            lo, hi = math.floor(h), math.ceil(h)
            plan[c].append((lo, hi, h - lo))
            ranks.update((lo, hi))
        wanted[c] = sorted(ranks)
    name = {c: f"q{i}" for i, c in enumerate(cols)}
    vals = values_at_ranks(wide_df, {name[c]: r for c, r in wanted.items()}, initial={name[c]: s for c, s in stats.items()}, wide=True, **kw)
    res = {}
    for c in cols:
        row = []
        for spec in plan[c]:
            if spec is None:
                row.append(None)
                continue
            lo, hi, frac = spec
            a, b = vals[name[c]][lo], vals[name[c]][hi]
            row.append(a + (b - a) * frac if frac else a)
        res[c] = row
    return res


def exact_mode(df: DataFrame, col: str):
    """Most frequent non-null value, ties -> smallest.  groupBy + TakeOrdered(1):
    partial counts are combined map-side, nothing unbounded is buffered."""
    row = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc(col)).limit(1).first())
    return None if row is None else row[col]


PREFIX_PARTS = 256  # buckets of a prefix sum, whatever the number of shuffle partitions


def balanced_cuts(df: DataFrame, col: str, parts: int = PREFIX_PARTS) -> list[float]:
    """Cut points of a numeric column with about rows / parts rows between two of them.

    Histogram rounds as in ``values_at_ranks``: only ranges that are still too full
    are split again, so at most ``parts`` ranges are open at a time and nothing
    that grows with the data is collected.  The cuts are plain numbers, fixed
    before anything is dealt out by them."""
    long_df = df.select(F.lit("c").alias("name"), F.col(col).cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    first = long_df.agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    if not first["n"]:
        return []
    full = max(1, first["n"] // parts)
    open_, done = [(first["lo"], first["hi"], first["n"])], []
    while open_:
        split = [w for w in open_ if w[2] > full and w[0] < w[1]]
        done += [w for w in open_ if not (w[2] > full and w[0] < w[1])]
        open_ = [(r["lo"], r["hi"], r["n"]) for r in _histogram(
            long_df, [("c", lo, hi) for lo, hi, _ in split], 64)] if split else []
    cuts, held = [], 0
    for lo, _, n in sorted(done):
        if held and held + n > full:
            cuts.append(lo)
            held = 0
        held += n
    return cuts


def running_sum_before(df: DataFrame, order_col: str, value_col: str, parts: int = PREFIX_PARTS) -> DataFrame:
    """Adds ``<value_col>_before``: the sum of ``value_col`` over rows with a
    smaller ``order_col`` (numeric, one row per distinct value expected).

    A distributed prefix sum: ``balanced_cuts`` fixes the buckets, ``Bucketizer``
    finds a row's bucket by binary search in the JVM, one window inside each
    bucket gives the local running sum, and the totals of the buckets before it
    are joined on (a table of at most a few times ``parts`` rows)."""
    from pyspark.ml.feature import Bucketizer
    from pyspark.sql import Window

    splits = [float("-inf"), *balanced_cuts(df, order_col, parts), float("inf")]
    b = (Bucketizer(splits=splits, inputCol="_ord", outputCol="_b", handleInvalid="keep")
         .transform(df.withColumn("_ord", F.col(order_col).cast("double"))))  # NaN has the last bucket
    totals = b.groupBy("_b").agg(F.sum(value_col).alias("_tot"))
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (b.withColumn("_local", F.coalesce(F.sum(value_col).over(local), F.lit(0)))
            .join(F.broadcast(offsets), "_b")  # one row for each bucket: bounded by the number of cuts
            .withColumn(f"{value_col}_before", F.col("_local") + F.col("_off"))
            .drop("_ord", "_b", "_local", "_off"))
