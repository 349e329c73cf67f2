import __spark_entry__
import compare
import pytest

from cdcflow.checks.oracle import ORACLE
from cdcflow.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = compare.oracle_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1350 + 135  # orders and customers
