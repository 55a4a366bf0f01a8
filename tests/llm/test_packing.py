import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from strata.llm import packing as K

from .conftest import ODD, SF, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, texts, library, capacity):
    """Every piece is there, with its checksum, and sequences are gapless and within bounds."""
    want = Counter()
    for i, t in texts:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s:s + capacity]
            want[(i, k, s, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at), sum(at.values())


def test_query(spark, library, documents):
    rows = E.queries()["op6_best_fit_packing"](spark, SF).collect()
    n, total = check(rows, documents.items(), library, 2048)
    assert n <= -(-total // 2048) + 1


@pytest.mark.parametrize("capacity", [16, 2048])
def test_odd_texts(spark, library, capacity):
    texts = ODD + ["A B's don't  I'LL", "a<|endoftext|>b", "Σ ΑΣ\tfoo　bar", "abc... x|. é., 3!! ½! Ⅷ,"] + ["same words"] * 9
    ids = [None, 3, 3, *range(3, len(texts))]
    rows = K.best_fit_packing(frame(spark, texts, ids), PATH, capacity).collect()
    check(rows, zip(ids, texts), library, capacity)
    assert rows[0].lang == "en"
    assert K.best_fit_packing(frame(spark, []), PATH, capacity).count() == 0


def sequences(histogram, capacity):
    rows = K.plan(histogram, capacity)
    used = Counter()
    for length, first, ranks, *_ in rows:
        assert first == used[length]
        used[length] += ranks
    assert used == Counter(histogram)
    return max((r[4] + r[2] // r[3] for r in rows), default=0)


def fewest(items, capacity):
    """Exact number of bins, by depth-first search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for room in sorted({b for b in bins if b >= items[k]}):
            rest = list(bins)
            rest.remove(room)
            go(k + 1, [*rest, room - items[k]])
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best


def test_plan_is_near_the_fewest():
    rng = random.Random(2)
    extra = 0
    for _ in range(60):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        extra += sequences(Counter(items), 20) - fewest(items, 20)
    assert extra <= 2
    assert sequences({}, 20) == 0
    assert sequences({2048: 1_000_000, 1: 3}, 2048) == 1_000_001
    assert sequences({1000: 10**9, 1048: 10**9}, 2048) == 10**9


def test_completion_fills_exactly_where_it_can():
    got = K.complete(10, [7, 6, 4, 3], [1, 1, 1, 1])
    assert sum(k * [7, 6, 4, 3][i] for i, k in got) == 10
    assert K.complete(2, [7, 3], [4, 4]) == []


def test_words_of_a_batch_are_looked_up_once(monkeypatch):
    """Ids come in slices of texts, words are handled once for all of them; ids are those of the library."""
    import pyarrow as pa

    texts = ["the cat, the dog.", None, "", "a,b; c!! 12, 3.4\nthe cat,", " two  spaces ", "…é, ?"] * 5 + ["the dog"]
    encoder = K.WordEncoder(PATH)
    calls, one = [], encoder.ids_of
    monkeypatch.setattr(encoder, "ids_of", lambda words: calls.append(len(words)) or one(words))
    got = [ids[a:b].tolist() for ids, offs in encoder.encode(pa.array(texts), 4) for a, b in zip(offs[:-1], offs[1:])]
    assert got == [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, K.END_ID] for t in texts]
    assert len(calls) == 1
    assert list(encoder.encode(pa.array([], pa.string()))) == []
