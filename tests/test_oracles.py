"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry
from tools.compare import compare, connect
from veristrata.workload import all_oracles as oracle_sql
from veristrata.workload import all_queries as queries

ORACLES = oracle_sql()


@pytest.fixture(scope="session")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, db, sf_dir, name):
    ok, text = compare(spark, db, sf_dir, name, queries()[name], ORACLES.get(name))
    assert ok, text


def test_every_query_has_sql():
    assert set(queries()) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 21
