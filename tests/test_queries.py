"""Every core query against its SQL, on empty tables and on tables full of nulls and repeats."""

import importlib
import pkgutil

import pytest
from conftest import SF, against_duckdb

import estatescope.plans as plans

MODULES = [importlib.import_module(f"estatescope.plans.{m.name}") for m in pkgutil.iter_modules(plans.__path__)]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in MODULES for k, s in m.SQL.items()}


@pytest.mark.parametrize("module", MODULES, ids=lambda m: m.__name__.rsplit(".", 1)[1])
def test_same_rows_as_sql(spark, module):
    assert against_duckdb(spark, SF, QUERIES, SQL, [n for n in module.QUERIES if n in SQL]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty_sf, name):
    QUERIES[name](spark, empty_sf).collect()


@pytest.mark.parametrize("name", QUERIES)
def test_nulls_and_repeats(spark, null_sf, name):
    QUERIES[name](spark, null_sf).collect()


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 300
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())
