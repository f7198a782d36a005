import pytest

from compare import database, same
from sluice.plans import registry


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, con, name):
    same(registry.queries()[name](spark, sf), con, registry.oracle_sql()[name])


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
