"""Every query of the library against its SQL; the training-data queries have tests of their own."""

import pytest

import __spark_entry__ as entry
from checks import frontier_queries, page_queries, record_queries, state_queries, text_queries
from checks.compare import difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()
MODULES = (text_queries, page_queries, frontier_queries, record_queries, state_queries)
OWN = [n for m in MODULES for n in m.QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    assert difference(spark, SF, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
