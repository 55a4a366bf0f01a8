"""The entry module with and without the corpus subpackage."""

import sys

import pytest

import __spark_entry__ as E
from strata.plans.registry import load_all


def test_own_queries_are_always_there():
    own, oracle = load_all()
    assert set(own) <= set(E.queries()) and set(oracle) <= set(E.oracle_sql())


@pytest.mark.parametrize("missing", ["corpus_pipeline", "strata.llm"])
def test_without_the_corpus_subpackage(monkeypatch, missing):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("strata.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # as if it were not installed
    own, oracle = load_all()
    assert set(E.queries()) == set(own) and set(E.oracle_sql()) == set(oracle)


@pytest.mark.parametrize("missing", ["xxhash", "public_tokenizers"])
def test_without_a_package_that_the_corpus_queries_need(monkeypatch, missing):
    pytest.importorskip("corpus_pipeline")
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("strata.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    with pytest.warns(UserWarning, match="left out"):
        assert set(E.queries()) == set(load_all()[0])


def test_import_errors_of_the_rest_are_raised(monkeypatch):
    pytest.importorskip("corpus_pipeline")
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("strata.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "strata.session", None)
    with pytest.raises(ImportError):
        E.queries()
