"""Every registered query against its SQL, or for rows where SQL cannot express it."""

import pytest

import __spark_entry__ as entry_points
from fieldkit.plans.catalog import CATALOG
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql is not None])
def test_query_equals_its_sql(spark, folder, con, name):
    assert differences(CATALOG[name], spark, folder, con) == []


@pytest.mark.parametrize("name", [n for n, q in CATALOG.items() if q.sql is None])
def test_query_without_sql_gives_rows(spark, folder, name):
    assert not CATALOG[name].run(spark, folder).isEmpty()


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() == 1
