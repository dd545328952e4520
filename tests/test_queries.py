"""Every bound query against its SQL, on the smallest tables."""

import __spark_entry__ as entry
import pytest

from quadloom import queries as tile_queries

SQL = tile_queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(name, agrees):
    agrees(tile_queries.queries()[name], SQL[name])


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_all_have_sql():
    assert set(tile_queries.queries()) == set(SQL)
