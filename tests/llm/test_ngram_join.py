import random
import re

import pytest

import __spark_entry__ as E
from strata.llm import ngram_join as N

from .conftest import ODD, SF, frame


def shingles(text, n):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_query_against_brute_force(spark, documents):
    ids = sorted(documents)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op4_ngram_join"](spark, SF).collect()}
    want = brute([documents[i] for i in ids], 4, 85)
    assert got == {i: (n, ids[c]) for i, (n, c) in zip(ids, want)}


def families():
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(300))
    shared = [word() for _ in range(40)]  # a passage that unrelated texts share
    texts = [" ".join([word() for _ in range(rng.randint(5, 60))] + shared) for _ in range(40)]
    for size in (30, 120):
        base = [word() for _ in range(size)]
        for edits in range(30):
            copy = list(base)
            for _ in range(edits % 6):
                copy[rng.randrange(size)] = word()
            texts.append(" ".join(copy).upper() if edits % 7 == 0 else " ".join(copy))
    return texts + ["one two", "One  Two", "one", "a b c d", "a b c d e"]


@pytest.mark.parametrize("block", [N.BLOCK, 7])
@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (1, 50)])
def test_families(spark, monkeypatch, block, words, percent):
    monkeypatch.setattr(N, "BLOCK", block)
    texts = families()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           N.ngram_components(frame(spark, texts), words, percent).collect()}
    assert got == dict(enumerate(brute(texts, words, percent)))


def test_odd_texts(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_components(frame(spark, ODD)).collect()}
    assert got == dict(enumerate(brute(ODD, 5, 80)))
    assert N.ngram_components(frame(spark, [])).count() == 0


def test_repeated_rows_and_null_ids(spark):
    texts = ["the same few words here now", "the same few words here now", "the same few words here now", "", None, "other"]
    ids = [4, 4, None, None, 7, None]
    rows = N.ngram_components(frame(spark, texts, ids)).collect()
    assert sorted((r.n_shingles, r.doc_id or -1, r.component_id or -1) for r in rows) == [
        (0, -1, -1), (0, 7, 7), (1, -1, -1), (2, -1, 4), (2, 4, 4), (2, 4, 4)]
    left = N.one_per_component(frame(spark, texts, ids)).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in left) == [
        (-1, ""), (-1, "other"), (4, "the same few words here now"), (7, "")]


def test_a_shared_prefix_token_under_every_order():
    import numpy as np
    rng = np.random.default_rng(4)
    levels = rng.integers(0, 3, 1 << 8).astype(np.uint8)
    for _ in range(300):
        base = rng.integers(0, 1 << 62, rng.integers(5, 60)).astype(np.uint64)
        x = np.unique(base)
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.08], rng.integers(0, 1 << 62, 2).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            for salt in N.ORDERS:
                assert len(np.intersect1d(N.prefix(x, levels, salt, 80), N.prefix(y, levels, salt, 80)))
