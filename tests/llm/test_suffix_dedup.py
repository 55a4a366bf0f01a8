import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from strata.llm import suffix_dedup as S

from .conftest import ODD, SF, frame


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p:p + 200] for r in raws for p in range(len(r) - 199))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, int)
        for p in range(len(r) - 199):
            if seen[r[p:p + 200]] > 1:
                gone[p] += 1
                gone[p + 200] -= 1
        gone = np.cumsum(gone)[:len(r)] > 0
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_query_against_brute_force(spark, documents):
    got = rows_of(E.queries()["op3_suffix_dedup"](spark, SF))
    assert got == dict(zip(documents, brute(documents.values())))


def planted():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common = word(260)
    texts = [word(rng.randint(50, 300)) + common + word(rng.randint(50, 300)) for _ in range(40)]
    base = word(900)
    for _ in range(25):  # near copies with one edit each
        k = rng.randrange(900)
        texts.append(base[:k] + word(3) + base[k:])
    texts += ["ab" * 400, "ab" * 130, common[:200], common[:199], base, base]
    return texts


@pytest.mark.parametrize("limit", [S.CELL_LIMIT, 3])
def test_planted_repeats(spark, monkeypatch, limit):
    """Borders, periods, edits; with the low limit the gram groups are counted instead of sorted."""
    monkeypatch.setattr(S, "CELL_LIMIT", limit)
    texts = planted()
    assert rows_of(S.suffix_dedup(frame(spark, texts))) == dict(enumerate(brute(texts)))


def test_odd_texts_and_repeated_rows(spark):
    texts = ODD + [ODD[10], ODD[10]]
    ids = list(range(len(ODD))) + [10, None]  # a repeated row and a null id
    got = S.suffix_dedup(frame(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    want = Counter(zip([i if i is not None else -1 for i in ids], brute(texts)))
    assert Counter((r.doc_id if r.doc_id is not None else -1, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
                   for r in got) == want
    assert S.suffix_dedup(frame(spark, [])).count() == 0


def test_long_texts_are_read_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", 1000)
    rng = random.Random(9)
    part = "".join(rng.choice("abcdefgh") for _ in range(700))
    text = "".join(rng.choice("abcdefgh") for _ in range(4000)) + part + "".join(rng.choice("xyz") for _ in range(3000)) + part
    import pyarrow as pa
    cells = list(S.chunked_cells(pa.array([text, part])))
    covered = np.zeros(len(text), bool)
    for row, p, shape, *_ in cells:
        for a, b in zip(p[row == 0], shape[row == 0] >> 16):
            covered[a:a + b] = True
    assert covered.all()


def test_suffix_sort_orders_like_python():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:2200] = data[200:900]
    raw = data.tobytes()
    pos = np.arange(len(raw) - S.SPAN + 1)
    rng.shuffle(pos)
    got = S.Suffixes(data).sort(pos, np.zeros(len(pos), np.int64))
    assert [raw[p:p + S.SPAN] for p in got] == sorted(raw[p:p + S.SPAN] for p in pos)
