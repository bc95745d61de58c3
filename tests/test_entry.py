"""The driver's entry point with and without the corpus subpackage."""

import importlib

import pytest

import __spark_entry__ as entry


def missing(name):
    def fail(wanted, *args):
        raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    return fail


@pytest.mark.parametrize("name", ["skyloom.llm", "skyloom.llm.queries", "corpus_pipeline"])
def test_queries_stand_without_the_corpus_operators(monkeypatch, name):
    monkeypatch.setattr(importlib, "import_module", missing(name))
    assert "qc_chain" in entry.queries() and not any(q.startswith("op") for q in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_other_import_errors_are_not_swallowed(monkeypatch):
    monkeypatch.setattr(importlib, "import_module", missing("numpy"))
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
