"""Every query with a SQL form must give DuckDB's rows and types."""

import pytest

from shillingflow.catalog import CATALOG

from .compare import check, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("key", [k for k, e in CATALOG.items() if e.sql])
def test_matches_sql(spark, duck, key):
    assert check(spark, duck, CATALOG[key], FOLDER) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["hour_bucket", "transaction_count", "total_amount", "unique_customers"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
