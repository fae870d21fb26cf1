import importlib
import sys

import pytest

import __spark_entry__


def reload_without(monkeypatch, *names):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("dayferry.llm")]:
        monkeypatch.delitem(sys.modules, name)
    for name in names:
        monkeypatch.setitem(sys.modules, name, None)
    spec = importlib.util.spec_from_file_location("entry_without", __spark_entry__.__file__)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.mark.parametrize("names", [("corpus_pipeline",), ("corpus_pipeline", "dayferry.llm")])
def test_entry_works_without_the_training_data_operators(monkeypatch, names):
    entry = reload_without(monkeypatch, *names)
    assert "window_sync" in entry.queries() and not [n for n in entry.queries() if n.startswith("op")]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_other_missing_modules_are_not_hidden(monkeypatch):
    pytest.importorskip("corpus_pipeline")
    with pytest.raises(ModuleNotFoundError):
        reload_without(monkeypatch, "xxhash")
