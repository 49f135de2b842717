"""Every named query must give exactly the rows of its SQL text in DuckDB."""

import pytest
from compare import compare, connect

from gridspark.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), ORACLES[name], con) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ORACLES) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
