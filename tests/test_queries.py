"""Every registered query: equal to its SQL, or at least a stable, non-empty result."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, mismatch

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert mismatch(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
