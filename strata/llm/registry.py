"""Queries of the corpus subpackage: key -> (spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

MODULES = (
    "line_dedup", "token_counts", "suffix_dedup", "ngram_join", "embedding_dedup", "sentencepieces", "packing", "quality", "secrets", "pii", "nearest", "hard_negatives", "spelling",
)


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> tuple[dict, dict]:
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")
    return dict(QUERIES), dict(ORACLE)
