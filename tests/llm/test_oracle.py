"""The text package's queries that SQL can express."""

import pytest

from faultweave.llm.queries import QUERIES, SQL
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    compare(spark, QUERIES[name], SQL[name], "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
