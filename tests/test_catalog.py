"""Every named query against its SQL over the same tables."""

import pytest

from quarrymill import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(name, same_rows):
    same_rows(catalog.QUERIES[name], catalog.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_has_rows(name, spark, sf):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
