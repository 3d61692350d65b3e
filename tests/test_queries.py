"""Every query against its SQL on the smallest scale factor."""

import os

import pytest

import __spark_entry__ as e
from runlens.catalog.queries import QUERIES
from compare import connect, spark_rows, sql_rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    rows = e.entry(spark).collect()
    assert len(rows) == 8 and "accumulated_ms1_tic" in rows[0].asDict()


def test_every_query_has_sql():
    # The queries for training text, where present, have their own tests.
    assert set(QUERIES) <= set(e.oracle_sql())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got = spark_rows(e.queries()[name](spark, SF))
    expected = sql_rows(con, e.oracle_sql()[name])
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert len(got[1]) > 0
