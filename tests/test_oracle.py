"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    first = entry.entry(spark)
    assert first.columns == ["page_id", "title", "language", "n_links"] and first.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, name):
    told = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert told in (None, "no rows"), told  # at the smallest scale a query may find nothing on both sides
