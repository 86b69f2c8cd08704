"""Every registered report equals its independent DuckDB statement on the
supplied tables (smallest scale here; tools/oracle_check.py runs sf0.01)."""

import pytest

from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

import __spark_entry__ as entry
from souk.plans import catalog


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.REGISTRY) <= set(entry.oracle_sql())
    assert len(catalog.REGISTRY) >= 58


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_matches_duckdb(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "customer_state", "aov", "state_rank"]
    assert df.count() > 0
