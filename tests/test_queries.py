"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, oracle_rows, spark_rows
from tidemark.workload.oracle import ORACLE_SQL
from tidemark.workload.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 12
    assert df.limit(1).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(contract.queries()[name](spark, FOLDER))
    expected_columns, expected = oracle_rows(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows
