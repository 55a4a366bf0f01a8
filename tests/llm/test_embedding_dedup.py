import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from strata.llm import embedding_dedup as D

from .conftest import SF


def brute(rows, least=0.93):
    """(links, component) by row number."""
    unit = []
    for _, v, label in rows:
        x = np.array(v, float) if v is not None and len(v) and all(c is not None for c in v) else None
        ok = x is not None and label is not None and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is None or unit[j] is None or rows[i][2] != rows[j][2] or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= least:
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return n, [find(i) for i in range(len(rows))]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 9) for r in rows],
                               "vec_id long, embedding array<float>, label int, lang string, n_links int")
    return D.near_duplicates(df)


def families(dim, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            base = rng.normal(size=dim)
            for k in range(8):
                v = base + rng.normal(size=dim) * 0.05 * k * np.linalg.norm(base) / np.sqrt(dim)
                rows.append((len(rows), v.astype(np.float32).tolist(), label))
            rows += [(len(rows) + k, rows[-1][1], label) for k in range(3)]  # copies
    return rows


@pytest.mark.parametrize("dim", [2, 7, 64, 100])
@pytest.mark.parametrize("block", [D.BLOCK, 5])
def test_families(spark, monkeypatch, dim, block):
    monkeypatch.setattr(D, "BLOCK", block)
    rows = families(dim)
    want_n, want_c = brute(rows)
    got = {r.vec_id: r for r in run(spark, rows).collect()}
    found = sum(r.n_links for r in got.values())
    assert 0.98 * sum(want_n) <= found <= sum(want_n)
    if found == sum(want_n):
        assert {i: (r.n_links, r.component_id) for i, r in got.items()} == dict(enumerate(zip(want_n, want_c)))
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    n, c = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.queries()["op7_embedding_dedup"](spark, SF).collect()}
    assert got == {rows[i][0]: (n[i], rows[c[i]][0], c[i] == i) for i in range(len(rows))}


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(0, None, 1), (1, [], 1), (2, [0.0, 0.0, 0.0], 1), (3, [1.0, None, 2.0], 1), (4, [float("nan"), 1.0, 1.0], 1),
            (5, [float("inf"), 1.0, 1.0], 1), (6, one, None), (7, one, 1), (8, one, 1), (9, [2.0, 4.0, 6.0], 1),
            (10, [-1.0, -2.0, -3.0], 1), (11, [1.0, 2.0], 1), (12, [3e38, 3e38, 3e38], 2), (13, [1e-38, 1e-38, 1e-38], 2),
            (14, one, 2)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in run(spark, rows).collect()}
    assert got == {**{i: (0, i) for i in (0, 1, 2, 3, 4, 5, 6, 10, 11)}, 7: (2, 7), 8: (2, 7), 9: (2, 7), 12: (1, 12),
                   13: (1, 12), 14: (0, 14)}
    again = run(spark, [(3, one, 1), (3, one, 1), (None, one, 1)]).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in again) == [
        (-1, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True)]
    assert run(spark, []).count() == 0


def test_recall_at_the_threshold():
    """Pairs just above the threshold share a bucket almost surely."""
    rng = np.random.default_rng(1)
    a = D.unit_rows(rng.normal(size=(2000, 64)))
    b = rng.normal(size=a.shape)
    b = D.unit_rows(b - (b * a).sum(1, keepdims=True) * a)
    v = 0.931 * a + np.sqrt(1 - 0.931**2) * b
    s, t = D.signatures(a), D.signatures(v)
    assert (s[..., None] == t[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.99


def test_hadamard_is_orthogonal():
    h = D.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))
