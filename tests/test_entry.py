"""The driver contract works with and without the llm subpackage."""
import sys

import pytest

import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def forget(monkeypatch):
    """Modules of the subpackage are imported anew."""
    import ledgerlens
    for name in [m for m in sys.modules if m.startswith("ledgerlens.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr(ledgerlens, "llm", raising=False)


@pytest.mark.parametrize("gone", ["ledgerlens.llm", "ahocorasick", "public_tokenizers", "numpy", "pyarrow"])
def test_without_the_llm_subpackage_or_a_library_it_needs(monkeypatch, gone):
    core = set(entry.registry.queries())
    forget(monkeypatch)
    monkeypatch.setitem(sys.modules, gone, None)  # its import fails
    names = set(entry.queries())
    assert names == core and "kpi_daily" in names
    assert set(entry.oracle_sql()) <= names


def test_without_the_pipeline(monkeypatch):
    forget(monkeypatch)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in entry.queries() and "kpi_daily" in entry.queries()
