"""Every query of the core against its SQL, and every other one for its schema."""

from __future__ import annotations

import pytest
from conftest import DATA, same_rows

from skylode.plans import catalogue

QUERIES = {n: f for m in catalogue.modules() for n, f in m.QUERIES.items()}
SQL = {n: s for m in catalogue.modules() for n, s in m.SQL.items()}


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, DATA), duck.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_a_package_of_llm(spark, monkeypatch):
    """A package that only the subpackage needs may be missing: the core's queries stay."""
    import importlib

    import __spark_entry__

    whole = importlib.import_module

    def missing(name, *a):
        if name.startswith("skylode.llm"):
            raise ModuleNotFoundError(name)
        return whole(name, *a)

    monkeypatch.setattr(importlib, "import_module", missing)
    assert set(__spark_entry__.queries()) == set(QUERIES)
