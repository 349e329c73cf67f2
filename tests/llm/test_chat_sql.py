import compare
import pytest

from llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    con = compare.oracle(SF_DIR)
    columns, rows = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = compare.oracle_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows
