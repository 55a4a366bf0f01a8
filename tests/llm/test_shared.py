import random

import pytest

from strata.llm.shared import components


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("kind", ["random", "path", "star", "none", "loops"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {"random": [(rng.randrange(60), rng.randrange(60)) for _ in range(40)],
             "path": [(k, k + 1) for k in range(64)], "star": [(63, k) for k in range(63)], "none": [],
             "loops": [(1, 1), (2, 3), (3, 2)]}[kind]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_remembered_words_are_bounded_by_bytes(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    from strata.llm.packing import WordEncoder
    from strata.llm.sentencepieces import PieceModel
    from strata.llm.textkern import Remembered
    from strata.llm.token_counts import PieceCounter

    monkeypatch.setattr(Remembered, "LIMIT", 1 << 20)
    makers = [(WordEncoder(public_tokenizers.path("word_bpe_49k.json")), "encode"),
              (PieceModel(public_tokenizers.path("piece_bpe_32k.model")), "encode"),
              (PieceCounter(public_tokenizers.path("byte_bpe_50k.json")), "counts")]
    for model, call in makers:
        for k in range(8):  # one "word" of 200 kB each
            getattr(model, call)(pa.array(["語" * 50000 + str(k), "few words"]))
            assert sum(len(w.encode()) for w in [*model.known, *model.known.old]) <= 3 << 20
