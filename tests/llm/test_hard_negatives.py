"""Hard negatives against brute force."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm import hard_negatives as H
from strata.llm.hard_negatives import hard_negatives
from strata.llm.registry import load_all

from .conftest import SF

SCHEMA = ("vec_id long, embedding array<double>, label int, x string, q string, cls string, ids string, tag string, low string, "
          "high string, best string, wanted string, dim string, rank string")


def table_of(spark, rows):
    """Rows (id, vector, label) with extra columns named like the operator's own."""
    return spark.createDataFrame([(*r, *"abcdefghijk") for r in rows], SCHEMA)


def brute(rows, every=50, positives=5, negatives=3):
    fine = []
    for i, v, lab in rows:
        if i is None or lab is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole = [math.floor(256 * c) for c in v]
        if sum(c * c for c in whole) < 2**62:
            fine.append((i, whole, lab))
    out = []
    for at, (i, v, lab) in enumerate(fine):
        if i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j, other) for k, (j, w, other) in enumerate(fine)
                  if k != at and len(w) == len(v)]
        scores.sort()
        for s, j, _ in [x for x in scores if x[2] == lab][:positives]:
            hard = [(-n, m) for n, m, other in scores if other != lab and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            out += [(i, j, r, m, -s, n) for r, (n, m) in enumerate(hard, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force_on_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    want = brute(rows)
    assert len(want) > 50
    assert got(load_all()[0]["op13_hard_negatives"](spark, SF)) == want
    assert got(hard_negatives(table_of(spark, [(i, list(map(float, v)), lab) for i, v, lab in rows]))) == want


def test_ties_copies_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-2, 4, 5) / 4).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    copy = [0.5, 0.25, 0.5, 0.0, 0.75]
    rows += [(1000 + i, copy, 0) for i in range(120)] + [(1200 + i, copy, 1) for i in range(30)]
    rows += [(50, rows[50][1], rows[50][2]), (100, copy, None), (None, copy, 1), (2000, None, 1), (2050, [], 1),
             (2100, [None, 1.0, 1.0, 1.0, 1.0], 1), (2150, [float("inf")] * 5, 1), (2200, [0.0] * 5, 1), (2250, [1e300] * 5, 2),
             (2300, [1.0, 1.0], 1), (2301, [0.5, 1.0], 1), (2302, [0.6, 0.4], 2), (2350, [-0.5] * 5, 7), (2351, [-0.001] * 5, 7)]
    assert got(hard_negatives(table_of(spark, rows))) == brute(rows)
    assert got(hard_negatives(table_of(spark, rows), every=10, positives=2, negatives=6)) == brute(rows, 10, 2, 6)


def test_scores_beyond_double_precision(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(2**20, 2**21, 4) + rng.integers(0, 256, 4) / 256.0).tolist(), i % 2) for i in range(200)]
    assert got(hard_negatives(table_of(spark, rows))) == brute(rows)


def test_many_cells_and_tiles(spark, monkeypatch):
    monkeypatch.setattr("strata.llm.tiles.MIN_PAIRS", 400)
    monkeypatch.setattr("strata.llm.tiles.QUERY_BLOCK", 8)
    rng = np.random.default_rng(10)
    rows = [(i, rng.standard_normal(24).tolist(), int(rng.integers(0, 4))) for i in range(900)]
    assert got(hard_negatives(table_of(spark, rows), every=15)) == brute(rows, 15)


def test_empty_tables_and_lone_rows(spark):
    assert hard_negatives(table_of(spark, [])).collect() == []
    assert hard_negatives(table_of(spark, [(50, [1.0], 1)])).collect() == []
    rows = [(50, [1.0], 1), (51, [1.0], 1), (52, [0.9], 2)]
    assert got(hard_negatives(table_of(spark, rows))) == brute(rows) != []


@pytest.mark.parametrize("share", [-1.0, 0.0, 0.2, 0.5, 0.9])
def test_no_pair_at_the_threshold_is_pruned(share):
    rng = np.random.default_rng(3)
    scale = 0.85 ** np.arange(40)
    x, a = (np.floor(256 * rng.standard_normal((n, 40)) * scale).astype(np.int64) for n in (300, 20))
    order = np.argsort(-(x**2).sum(axis=0))
    q, rows = H.Rows(a, order), H.Rows(x, order)
    every = a @ x.T
    threshold = np.ceil(share * every.max(axis=1).astype(float))
    i, j, score = H.reaching(q, np.arange(20), threshold, rows)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(every >= threshold[:, None]))))
    assert (score == every[i, j]).all()
