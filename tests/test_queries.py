"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from checker import compare, connect
from crawlweave.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    ok, message = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], SF_DIR)
    assert ok, message


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["country", "total_requests", "avg_duration", "success_count"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
