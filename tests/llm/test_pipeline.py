import corpus_pipeline as C
from strata.llm.shared import landed

from .conftest import SF, frame
from .test_line_dedup import brute as lines_left
from .test_ngram_join import brute as groups
from .test_pii import base as personal
from .test_quality import base as quality_base


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    for name, stage in C.STAGES:
        docs = landed(stage(spark, docs, SF), f"test-{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        assert all(r.n_chars == len(r.text) for r in rows)
        if name == "quality_rules":
            for i in after:
                n, *_, again = quality_base(before[i])
                assert n >= 20 and 100 * again <= 30 * n and after[i] == before[i]
            assert len(after) > 0.6 * len(before)
        elif name == "line_dedup":
            ids = sorted(before)
            want = {i: t for i, (t, gone) in zip(ids, lines_left([before[i] for i in ids])) if not gone or t.split()}
            assert after == want
        elif name == "ngram_join":
            ids = sorted(before)
            found = groups([before[i] for i in ids], 5, 80)
            assert set(after) == {ids[c] for _, c in found}
            assert all(after[i] == before[i] for i in after)
        elif name == "pii":
            assert set(after) == set(before)
            for i, t in before.items():
                assert (after[i] == t) == (not personal(t))
                assert not any(x.startswith(("email", "card", "phone")) for x in personal(after[i]))
        before = after
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(before)
    assert max(r.offset + r.length for r in rows) <= 2048


def test_run_is_the_stages(spark):
    out = C.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_nothing_is_left_of_a_multi_line_copy(spark):
    import random
    rng = random.Random(12)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    texts = {}
    for r in rows:
        if r.text and r.text.count("\n") > 2 and len(r.text.split()) > 40:
            texts.setdefault(r.text, r)
    chosen = rng.sample(list(texts.values()), 12)
    planted = [r.asDict() | {"doc_id": 10**9 + k} for k, r in enumerate(chosen + chosen[:4])]
    docs = spark.createDataFrame([r.asDict() for r in rows] + planted, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in C.STAGES:
        docs = landed(stage(spark, docs, SF), f"planted-{name}")
        if name == "quality_rules":
            kept = {r.doc_id for r in docs.collect()}
            assert sum(r.doc_id in kept for r in chosen) > 3  # the first of a text stays
        if name == "ngram_join":
            break
    assert not [r.doc_id for r in docs.collect() if r.doc_id >= 10**9]


def test_the_first_of_a_text_stays(spark):
    docs = frame(spark, ["a b", "a b", "a b", "a b", "c", None, ""], [7, 3, 3, None, None, 5, 4])
    assert sorted((r.doc_id or -1, r.text) for r in C._without_copies(docs, docs).collect()) == [
        (-1, "c"), (3, "a b"), (3, "a b"), (4, "")]
