"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow.parquet as pq
import pytest

from strata.llm.registry import load_all
from strata.llm.spelling import near_pairs, prefix_and_pivots, spelling_variants

from .conftest import ODD, SF, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows, every=31):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def brute(n):
    near = {w: [] for w in n}
    masks = {}
    for w in n:  # words one edit apart share the word without one letter
        for k in range(len(w)):
            masks.setdefault(w[:k] + w[k + 1:], set()).add(w)
        masks.setdefault(w, set()).add(w)
    pairs = {p for some in masks.values() for p in combinations(sorted(some), 2)}
    for a, b in pairs:
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_brute_force_on_whole_tables(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    want = brute(words_of(rows))
    assert sum(r[1] is not None for r in want) > 5
    assert got(load_all()[0]["op12_spelling_variants"](spark, sf)) == want


def test_chains_ties_and_odd_texts(spark):
    words = ["elephant"] * 2000 + ["elephent"] * 150 + ["elephents"] * 12 + ["elephen"] * 3 + ["ELEPHANTS"] * 2000 + ["Éclairée"] * 40
    words += ["éclairée"] * 3 + ["aaaaaaaa"] * 30 + ["aaaaaaa"] * 2 + ["aaaaaaaaa"] * 300 + ["abababab"] * 3 + ["bababab"] * 50
    random.Random(1).shuffle(words)
    texts = [*ODD, " ".join(words[:2000]), "-".join(words[2000:]), "x" * 3000 + " " + "x" * 3000, "mötley×÷crew mötley×÷crew"]
    rows = [*enumerate(texts), (None, "wonderful wonderful wonderfull wonderful"), (7, "wonderfull"), (7, "wonderfull")]
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    assert got(spelling_variants(df)) == brute(words_of(rows))
    assert got(spelling_variants(df, delete_every=None)) == brute(words_of(rows, None))


def test_all_near_pairs_of_dense_words(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(300)}
    words |= {"".join(rng.choice("abcdé") for _ in range(rng.randint(7, 30))) for _ in range(300)}
    for w in list(words)[:200]:
        k = rng.randrange(len(w))
        words |= {w[:k] + "z" + w[k:], w[:k] + "z" + w[k + 1:], w + w[-1], w[0] + w}
    pairs = {tuple(r) for r in near_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert pairs == {tuple(sorted(p)) for p in combinations(words, 2) if one_edit(*p)}


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(7, 14)))
        count = {a + b: rng.randint(1, 9) for a in "abcd" for b in "abcd"}
        last, places, pivots = prefix_and_pivots(word, count)
        grams = [word[i:i + 2] for i in range(len(word) - 1)]
        key = lambda g: (count[g], g)
        assert places == [i for i, g in enumerate(grams) if key(g) <= key(last)] and len(places) >= 3
        cost = min(count[grams[a]] + count[grams[b]] for a, b in combinations(places, 2) if b - a >= 2)
        assert pivots[1] - pivots[0] >= 2 and sum(count[grams[p]] for p in pivots) == cost and set(pivots) <= set(places)


def test_empty_tables(spark):
    assert got(spelling_variants(frame(spark, []))) == []
    assert got(spelling_variants(frame(spark, [None, "", "short words only"]))) == []
