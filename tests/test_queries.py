"""Every query against its SQL on DuckDB."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from conftest import DATA
from linkledger.plans import catalog
from linkledger.plans.fixture_run import SETTINGS

OWN = catalog.all_queries(SETTINGS)
QUERIES, SQL = ({n: v for n, v in found.items() if n in OWN} for found in (queries(), oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return check.connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) == set(OWN)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check.compare(spark, con, DATA, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
