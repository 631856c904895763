"""Every registered query against its SQL on the same tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points

SF_DIR = oracle.data_dir(os.environ.get("TEST_SF", "0.001"))
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(SF_DIR is None, reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        difference, rows = oracle.compare(result, con, SQL[name])
        assert difference is None
    else:
        result.collect()


def test_names_match():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
