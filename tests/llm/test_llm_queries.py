"""Training-data queries against SQL, on empty tables and on tables full of nulls, repeats and clashing names."""

import pytest
from conftest import SF, against_duckdb

from estatescope.llm import queries as q


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n in q.SQL])
def test_same_rows_as_sql(spark, name):
    assert against_duckdb(spark, SF, q.QUERIES, q.SQL, [name]) == []


@pytest.mark.parametrize("name", q.QUERIES)
def test_empty_tables(spark, empty_sf, name):
    rows = q.QUERIES[name](spark, empty_sf).collect()
    assert rows == []


@pytest.mark.parametrize("name", q.QUERIES)
def test_nulls_and_repeats(spark, null_sf, name):
    got = q.QUERIES[name](spark, null_sf)
    rows = [tuple(map(str, r)) for r in got.collect()]
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
