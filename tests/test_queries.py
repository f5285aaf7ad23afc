"""The registered queries against their SQL, over the whole smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.core_queries()) == set(entry.core_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.core_queries())
def test_query(spark, database, name):
    assert compare(spark, database, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None
