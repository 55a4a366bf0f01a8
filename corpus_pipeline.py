"""Corpus pipeline: quality rules, line dedup, near-duplicate join, personal data, packing.

Every stage works on all its predecessor kept and is written as Parquet before
the next one reads it.  All stages but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.

Byte-equal copies leave with the first stage: line dedup would take only their
repeated chunks and pass the lines between them on as documents of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.line_dedup import line_dedup
from strata.llm.ngram_join import one_per_component
from strata.llm.packing import best_fit_packing
from strata.llm.pii import redact
from strata.llm.quality import quality_rules
from strata.llm.shared import boxed, landed, quoted, text_digest, unboxed

TOKENIZER = "word_bpe_49k.json"

# The quality classifier and the pattern graph have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def _without_copies(docs: DataFrame, of: DataFrame) -> DataFrame:
    """``docs`` without the texts that another row of ``of`` has under a smaller id; null ids come last.

    Rows equal in id and text are one document and stay together.
    """
    key = text_digest("doc_id", "text")
    same = of.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256)).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key.alias("__key"))).alias("first"))
    keyed = docs.select(boxed(docs.columns), key.alias("__key"))
    return keyed.join(same.select("first.__key"), "__key", "left_semi").select(*unboxed(docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, one of each text (the rules judge the text alone)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without_copies(quality_rules(docs, labels).filter("kept").select(*map(quoted, docs.columns)), docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents of which no word is left go."""
    left = line_dedup(docs).filter((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _measured(left.select(*map(quoted, docs.columns)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return one_per_component(docs, words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _measured(redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences."""
    return best_fit_packing(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
