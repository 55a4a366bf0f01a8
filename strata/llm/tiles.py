"""Block joins of a set of query vectors with all vectors, and helpers for vectors in Arrow batches.

A block join deals queries and rows out to the cells of a grid: a query goes to
every strip of rows, a row to every block of queries.  A cell is one group of a
shuffle; its queries are held, its rows stream past in tiles.  The grid follows
the counts of both sides: the number of cells grows with the product of the
counts, blocks and strips are balanced so that the least is copied, and no block
holds more than QUERY_BLOCK queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import landed

QUERY_BLOCK = 1 << 14  # queries held by a cell
MIN_PAIRS = 1 << 18  # pairs of a cell: no fewer, so that small inputs are not cut up
MAX_PAIRS = 1 << 32  # and no more, so that a lost cell is soon made again
TILE = 1024  # rows of a cell that are compared together
SIDE = 2048  # queries compared with a tile at once


def packed_vectors(vectors: pa.Array, change: Callable[[np.ndarray], np.ndarray] | None = None, zero: bool = False,
                   dtype=np.float64) -> pa.Array:
    """Each vector as the bytes of ``dtype``; null for one that is null, empty or holds null or non-finite components.

    ``change`` maps the components, as doubles; without ``zero`` vectors of length zero become null too.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    valid = np.asarray(vectors.is_valid())
    lens = np.asarray(vectors.value_lengths().fill_null(0)).astype(np.int64)
    x = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lens)
    fine = np.isfinite(x)

    def holding(mask: np.ndarray) -> np.ndarray:
        cum = np.concatenate(([0], np.cumsum(mask)))
        return cum[ends] - cum[ends - lens]

    ok = valid & (lens > 0) & (holding(~fine) == 0)
    if not zero:
        ok &= holding(fine & (x != 0)) > 0
    x = x[np.repeat(ok, lens)]
    x = (change(x) if change else x) + 0.0  # no negative zeros: equal vectors have equal bytes
    offs = np.concatenate(([0], np.cumsum(np.where(ok, lens, 0) * np.dtype(dtype).itemsize)))
    kind, width = (pa.binary(), np.int32) if offs[-1] < 2**31 else (pa.large_binary(), np.int64)
    out = pa.Array.from_buffers(kind, n, [pa.array(ok).buffers()[1], pa.py_buffer(offs.astype(width)),
                                          pa.py_buffer(np.ascontiguousarray(x.astype(dtype)))])
    return out.cast(pa.binary())


def matrix(raw: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a binary column whose values have one length and none of which is null."""
    raw = raw.cast(pa.large_binary())
    offs = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2], np.uint8)[offs[0]:offs[-1]].view(dtype).reshape(len(raw), -1)


def dealt(queries: DataFrame, rows: DataFrame, group: list[str], key: str, name: str) -> DataFrame:
    """Rows of both sides with __block, __strip and __side (0: query), grouped by cell, queries first.

    Both sides have the columns of ``group`` and the column ``key`` of whole
    numbers; a query meets the rows of its own group only.  Columns that one
    side lacks are null there.
    """
    spark = queries.sparkSession
    sizes = landed(rows.groupBy(*group).agg(F.count("*").alias("__n")).join(
        queries.groupBy(*group).agg(F.count("*").alias("__q")), group), f"{name}-sizes")
    total = sizes.agg(F.sum(F.col("__n").cast("double") * F.col("__q"))).first()[0] or 0.0
    wanted = total / (2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    per = float(min(max(wanted, MIN_PAIRS), MAX_PAIRS))
    n, q = F.col("__n").cast("double"), F.col("__q").cast("double")
    cells = F.ceil(n * q / F.lit(per))
    blocks = F.greatest(F.ceil(F.sqrt(cells * q / n)), F.ceil(q / F.lit(float(QUERY_BLOCK))))
    sizes = sizes.select(*group, F.least(blocks, q).cast("int").alias("__g"),
                         F.least(F.ceil(cells / blocks), n).cast("int").alias("__h"))
    place = F.xxhash64(key)
    left = queries.join(sizes, group).select(
        *queries.columns, F.lit(0).alias("__side"), F.pmod(place, F.col("__g")).cast("int").alias("__block"),
        F.explode(F.sequence(F.lit(0), F.col("__h") - 1)).alias("__strip"))
    right = rows.join(sizes, group).select(
        *rows.columns, F.lit(1).alias("__side"), F.explode(F.sequence(F.lit(0), F.col("__g") - 1)).alias("__block"),
        F.pmod(place, F.col("__h")).cast("int").alias("__strip"))
    cell = [*group, "__block", "__strip"]
    return left.unionByName(right, allowMissingColumns=True).repartition(*cell).sortWithinPartitions(*cell, "__side", key)


def cells(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """(queries, tiles of rows) of each cell, in the order of ``dealt``.  The tiles must be used up before the next cell."""
    names = [*group, "__block", "__strip"]

    def runs():
        """Slices of one cell and one side, in order."""
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_pylist() for c in (*names, "__side")]
            keys, at = list(zip(*cols)), 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[at]:
                    yield keys[at][:-1], keys[at][-1], batch.slice(at, k - at)
                    at = k

    stream, ahead = runs(), []

    def following():
        if not ahead:
            ahead.append(next(stream, None))
        return ahead[0]

    while (head := following()) is not None:
        here, held = head[0], []
        while (one := following()) is not None and one[0] == here and one[1] == 0:
            held.append(ahead.pop()[2])

        def tiles():
            while (one := following()) is not None and one[0] == here:
                part = ahead.pop()[2]
                for lo in range(0, part.num_rows, TILE):
                    yield part.slice(lo, TILE)

        if held:
            yield pa.Table.from_batches(held).combine_chunks(), tiles()
        for _ in tiles():
            pass
