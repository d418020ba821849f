"""Every registered query: against its SQL where it has one, else that it gives rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["p_brand", "avg_size"] and result.count() >= 5


def test_registry():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
