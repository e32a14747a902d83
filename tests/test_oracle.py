"""Every registered query against its SQL on the given tables."""

import pytest
from check_oracle import compare, connect
from conftest import SF_DIR

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) <= set(entry.LLM_QUERIES)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(name, spark, sf_dir, con):
    problem = compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0
