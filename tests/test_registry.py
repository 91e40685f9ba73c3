"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as registry
from oracle_check import compare, duck

# Those of the optional subpackage have tests of their own.
OPTIONAL = {name for name in registry.queries() if name == "pipeline" or name.startswith("op")}
QUERIES = {name: query for name, query in registry.queries().items() if name not in OPTIONAL}
ORACLE = {name: sql for name, sql in registry.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert registry.entry(spark).columns == ["query_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, sf, name):
    assert compare(spark, connection, sf, QUERIES[name], ORACLE[name]) == ""
