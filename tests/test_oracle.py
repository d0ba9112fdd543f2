"""Every registered query of the core against its SQL on the smallest tables."""

import pytest

from faultweave.plans import incidents, incidents_sql, preparation, preparation_sql, streams
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
PAIRS = [(n, q[n], s[n]) for q, s in ((incidents.QUERIES, incidents_sql.SQL), (preparation.QUERIES, preparation_sql.SQL), (streams.QUERIES, streams.SQL)) for n in q if n in s]


@pytest.mark.parametrize("name,query,sql", PAIRS, ids=[p[0] for p in PAIRS])
def test_query_equals_sql(spark, name, query, sql):
    compare(spark, query, sql, SF)


def test_every_sql_has_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
