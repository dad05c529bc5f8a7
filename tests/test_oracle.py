"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as entry_mod
from compare import compare, duck
from conftest import SF001
from ledgerloom.plans.catalog import QUERIES as OWN

QUERIES = {k: v for k, v in entry_mod.queries().items() if k in OWN}
SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF001), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["snapshot_date", "transaction_date", "top_rank_id", "store_total_sales", "store_token",
                          "store_name"]
