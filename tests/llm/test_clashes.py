"""Extra columns named like anything inside the operators come back as they were."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from strata.llm.embedding_dedup import near_duplicates
from strata.llm.line_dedup import line_dedup
from strata.llm.ngram_join import ngram_components, one_per_component
from strata.llm.packing import best_fit_packing
from strata.llm.pii import pii_spans, redact
from strata.llm.quality import quality_rules
from strata.llm.secrets import secret_scan
from strata.llm.sentencepieces import encode_pieces
from strata.llm.suffix_dedup import suffix_dedup
from strata.llm.token_counts import token_counts

INSIDE = ["n", "need", "prefix", "s1", "s2", "root", "cls", "whole", "unsure", "count", "w", "others", "more", "base", "found", "key",
          "seed", "pattern", "gram", "cell", "shape", "raw", "lv", "tok", "pivot", "sig", "dim", "x", "ids", "at", "m", "p", "h", "c",
          "Count", "weight", "held", "rank", "__key", "__row", "__own", "__t", "__id", "__text", "__q", "__x", "__found", "a.b", "a`b"]
INSIDE = [c for k, c in enumerate(INSIDE) if c.lower() not in {d.lower() for d in INSIDE[:k]}]


def extra(df):
    return df.select("*", *[F.concat(F.lit(f"{c}="), F.col(df.columns[0]).cast("string")).alias(c) for c in INSIDE])


def documents(spark):
    copy = "one line that is long enough to count\nand a second one of the same text\n" * 4 + "mail bob@example.org at 10.0.0.1 password=abcdef123"
    texts = [copy, copy + " and", copy, "short", None, "", " ".join(f"w{i}" for i in range(3000))]
    return extra(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string"))


def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda s, d: line_dedup(d),
    "op2": lambda s, d: token_counts(d, public_tokenizers.path("byte_bpe_50k.json")),
    "op3": lambda s, d: suffix_dedup(d),
    "op4": lambda s, d: ngram_components(d),
    "op4 stage": lambda s, d: one_per_component(d),
    "op5": lambda s, d: quality_rules(d, labels(s)),
    "op6": lambda s, d: best_fit_packing(d, public_tokenizers.path("word_bpe_49k.json")),
    "op8": lambda s, d: encode_pieces(d, public_tokenizers.path("piece_bpe_32k.model")),
    "op9": lambda s, d: secret_scan(d),
    "op10": lambda s, d: pii_spans(d),
    "op10 stage": lambda s, d: redact(d),
}


@pytest.mark.parametrize("op", OPERATORS)
def test_operators_on_texts(spark, op):
    out = OPERATORS[op](spark, documents(spark))
    rows = out.collect()
    ends = [c for c in INSIDE if op != "op4" or c != "__key"]  # that operator returns keys of its own
    assert rows and all(r[c] == f"{c}={r.doc_id}" for r in rows for c in ends if not (op, c) == ("op8", "ids"))
    assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_embeddings(spark):
    df = extra(spark.createDataFrame([(i, [1.0, float(i % 2)], 0) for i in range(6)], "vec_id long, embedding array<double>, label int"))
    rows = near_duplicates(df).collect()
    assert len(rows) == 6 and all(r[c] == f"{c}={r.vec_id}" for r in rows for c in INSIDE)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, ""), (None, None), (2, " \n ")]])
def test_pipeline_stages_on_empty_and_null_texts(spark, tmp_path, rows):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.collect()


def test_pipeline_stages_keep_other_columns(spark, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark).filter("doc_id > 5")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        rows = docs.collect()
        assert rows and all(r[c] == f"{c}={r.doc_id}" for r in rows for c in INSIDE)
