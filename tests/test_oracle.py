"""Every registered query against DuckDB, value by value."""

import pytest

import __spark_entry__ as entry
from kpiloom import catalog
from oracle import ORACLE
from tests.compare import compare, duck

QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, connection):
    assert compare(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
