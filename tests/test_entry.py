"""The entry module with and without the optional subpackage."""

import sys

import __spark_entry__


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_names_match():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_works_without_the_optional_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("fleetlens.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "fleetlens.llm", None)
    names = __spark_entry__.queries()
    assert names and "pipeline" not in names and not any(n.startswith("op") for n in names)
    assert __spark_entry__.oracle_sql()
