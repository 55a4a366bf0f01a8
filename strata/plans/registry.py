"""Query registry: key -> (spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def load_all():
    """Import every module that registers queries."""
    from . import gold_queries, silver_queries, bronze_queries, profile_queries, ml_queries  # noqa: F401
    from ..streaming import ingest  # noqa: F401
    return QUERIES, ORACLE
