"""Every query runs, has a stable schema, and equals its SQL twin in DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from cabstrata.plans import registry


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.SQL) <= set(registry.QUERIES)


@pytest.fixture(scope="session")
def duck(small):
    return compare.views(small)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_equals_its_twin(spark, small, duck, name):
    df = registry.QUERIES[name](spark, small)
    if name in registry.SQL:
        compare.check(df, duck, registry.SQL[name])
    else:
        assert df.count() >= 0


def test_entry(spark):
    a, b = entry.entry(spark), entry.entry(spark)
    assert a.schema == b.schema and a.count() > 0


def test_without_the_libraries_of_the_llm_queries(monkeypatch):
    """A missing library takes those queries away and no others."""
    import importlib

    real = importlib.import_module
    monkeypatch.setattr(entry.importlib, "import_module", lambda n: (_ for _ in ()).throw(ModuleNotFoundError("regex", name="regex")) if n == "cabstrata.llm.queries" else real(n))
    assert set(entry.queries()) == set(registry.QUERIES) and set(entry.oracle_sql()) == set(registry.SQL)
