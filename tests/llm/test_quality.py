import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import __spark_entry__ as E
from strata.llm import quality as Q

from .conftest import ODD, SF, frame


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, mark = Counter(windows), [False] * len(words)
    for i, w in enumerate(windows):
        if count[w] > 1:
            mark[i:i + 8] = [True] * 8
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, sum(mark))


def check(row, text):
    want = base(text)
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
    assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert not (row.base_failed and row.kept)


def test_query(spark, documents):
    rows = E.queries()["op5_quality_rules"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(documents)
    for r in rows:
        check(r, documents[r.doc_id])


def test_odd_texts_without_labels(spark):
    texts = ODD + ["a b c d e f g h " * 4, "line one\nline one\n\n \nline one", "#*$%&|<> " * 30]
    labels = spark.createDataFrame([(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, texts, [0] * len(texts))
    rows = Q.quality_rules(docs, labels).collect()
    assert len(rows) == len(texts) and rows[0].lang == "en"
    for r in rows:
        check(r, r.text)
        assert r.kept == (not r.base_failed)  # nothing was fitted, so the base rules decide
    assert Q.quality_rules(frame(spark, []), labels).count() == 0


def fitted(spark, texts, labels):
    docs = frame(spark, texts)
    return Q.fit_scorer(docs.select("doc_id", "text"), spark.createDataFrame(
        [(i, int(q), int(t)) for i, (q, t) in enumerate(labels)], "doc_id long, quality int, toxic int"))


def test_held_out_rows(spark):
    """Weights from three quarters of the rows judge the last quarter."""
    rng = np.random.default_rng(0)
    good = [f"w{i}" for i in range(400)]
    rude = ["nasty", "awful", "rotten"]
    texts, labels = [], []
    for _ in range(800):
        words = list(rng.choice(good, 60))
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            for p in rng.integers(0, 60, 4):
                words[p] = rude[p % 3]
        texts.append(" ".join(words))
        labels.append((0 if bad else 1, int(toxic)))
    labels = np.array(labels, float)
    got = Q.features_of(pa.array(texts[600:]), fitted(spark, texts[:600], labels[:600]))
    assert ((np.array(got.field("p_quality")) >= 0.5) == (labels[600:, 0] == 1)).mean() > 0.97
    assert ((np.array(got.field("p_toxic")) >= 0.5) == (labels[600:, 1] == 1)).mean() > 0.95


def test_accuracy_on_given_labels(spark):
    """Of the rows of a larger table: fitted on three quarters, judged on the last."""
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pylist()}
    labels = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pylist()
    rows = [r for r in labels if r["doc_id"] in docs]
    y = np.array([(r["quality"], r["toxic"]) for r in rows], float)
    texts = [docs[r["doc_id"]] for r in rows]
    cut = len(rows) * 3 // 4
    got = Q.features_of(pa.array(texts[cut:]), fitted(spark, texts[:cut], y[:cut]))
    kept = (np.array(got.field("p_quality")) >= 0.5) & (np.array(got.field("p_toxic")) < 0.5)
    assert kept[(y[cut:] == (1, 0)).all(axis=1)].mean() > 0.95
    assert kept[y[cut:, 0] == 0].mean() < 0.2
    assert kept[y[cut:, 1] == 1].mean() < 0.2


def test_the_rows_of_the_fit(spark):
    """As many as asked for, of each combination of labels, a repeated id once, null texts as empty ones."""
    docs = frame(spark, [None, "b", "a", *map(str, range(97))], [0, 1, 1, *range(3, 100)])
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else 1) for i in range(100)] + [(None, 1, 1), (500, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = Q.chosen_rows(docs.select("doc_id", "text"), labels, 1000).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, *range(3, 100)]
    assert {r.doc_id: r.text for r in rows}[0] == "" and {r.doc_id: r.text for r in rows}[1] == "a"
    few = Q.chosen_rows(docs.select("doc_id", "text"), labels, 40).collect()
    assert 30 <= len(few) <= 40 and {(r.quality, r.toxic) for r in few} == {(0, None), (1, None), (0, 1), (1, 1)}
    assert Q.chosen_rows(docs, labels.filter("doc_id is null"), 40) is None


def test_rows_are_shared_out_evenly():
    assert Q.shares({"a": 3, "b": 100, "c": 100}, 43) == {"a": 3, "b": 20, "c": 20}
    assert Q.shares({"a": 1, "b": 2}, 10) == {"a": 1, "b": 2}
    assert Q.shares({}, 10) == {}


def test_weights_restore_the_share_of_a_class():
    rng = np.random.default_rng(0)
    y = (np.arange(4000) % 2).astype(float)  # half of the sample, a tenth of the table
    margin = rng.normal(2 * y - 1, 1.5)
    slope, offset = Q._platt(margin, y, np.where(y > 0, 1.0, 9.0))
    p = 1 / (1 + np.exp(-(slope * margin + offset)))
    assert abs(np.average(p, weights=np.where(y > 0, 1.0, 9.0)) - 0.1) < 0.01
