"""Every registered query against its SQL, every column type and value."""

import pytest

import __spark_entry__
from fixtures.oracle import ORACLE
from fixtures.queries import QUERIES
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert ORACLE.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert_same(QUERIES[name](spark, SF_DIR), con, ORACLE[name])


def test_entry(spark):
    rows = __spark_entry__.entry(spark)
    assert len(rows.columns) == 42
    assert rows.count() > 0
