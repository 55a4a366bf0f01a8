"""Nearest neighbours against brute force."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm import nearest as N
from strata.llm.nearest import nearest

from .conftest import SF

SCHEMA = "vec_id long, embedding array<double>, label int, x string, q string, cls string, ids string, best string, dim string"


def table_of(spark, rows, kind="double"):
    """Rows (id, vector) with extra columns named like the operator's own."""
    return spark.createDataFrame([(i, v, 0, *"abcdef") for i, v in rows], SCHEMA.replace("double", kind))


def brute(rows, k=20, every=20):
    """rows: (id, vector) in any order."""
    fine = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = []
    for at, (i, v) in enumerate(fine):
        if i % every:
            continue
        hits = sorted((-float((v * w).sum()), j) for b, (j, w) in enumerate(fine) if b != at and len(w) == len(v))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(hits, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def same(a, b):
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert np.allclose([r[3] for r in a], [r[3] for r in b], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force_on_whole_tables(spark, kind):
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in rows]
    df = table_of(spark, rows, kind)
    same(got(nearest(df)), brute(rows))


def test_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]) for i in range(100)]  # copies, queries among them
    rows += [(40, rows[40][1]), (60, [0.5] * 6), (None, [1.0] * 6), (2000, None), (2020, []), (2040, [0.0] * 6),
             (2060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2080, [float("nan")] * 6), (2100, [float("inf")] * 6),
             (2120, [3.0, 4.0]), (2121, [1.0, -1.0]), (2140, [-0.0, 0.0, 1.0, 0.0, 0.0, 0.0]), (0, [1e-300] * 6),
             (2160, [7.0, 1.0, 2.0])]
    same(got(nearest(table_of(spark, rows), k=7)), brute(rows, k=7))


def test_many_cells_and_tiles(spark, monkeypatch):
    monkeypatch.setattr("strata.llm.tiles.MIN_PAIRS", 500)
    monkeypatch.setattr("strata.llm.tiles.QUERY_BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(16) * rng.choice([0.01, 1, 50])).tolist()) for i in range(900)]
    same(got(nearest(table_of(spark, rows), k=5, every=9)), brute(rows, k=5, every=9))


def test_fewer_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])]
    same(got(nearest(table_of(spark, rows))), brute(rows))
    assert nearest(table_of(spark, [])).collect() == []
    assert nearest(table_of(spark, [(20, None), (40, [0.0])])).columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("dims", [3, 64, 1500])
def test_intervals_hold_the_true_products(dims):
    rng = np.random.default_rng(dims)
    q, c = (N.Quantised(rng.standard_normal((40, dims)) * 10.0 ** rng.integers(-8, 8, (40, 1))) for _ in range(2))
    near, err = N.intervals(q, 0, 40, c)
    assert (np.abs(near - q.x @ c.x.T) <= err).all()
    # and they are of use: a few hundredths of the largest product
    assert np.median(err / (q.norm[:, None] * c.norm)) < 0.05


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, -1e200]), (2, [1e200, 1e200]), (20, [1e-200, 0.0]), (3, [1.0, 1.0])]
    hits = got(nearest(table_of(spark, rows)))
    assert [(r[0], r[2]) for r in hits if r[0] == 0] == [(0, 2), (0, 3), (0, 20), (0, 1)]
