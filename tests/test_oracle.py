"""Every registered query equals its DuckDB oracle (row count, column names,
order-insensitive values) on sf0.001, as the driver checks at sf0.01."""
import pytest

import __spark_entry__ as E
from quaybook.plans.queries import QUERIES
from oracle_check import compare, duck_connection
from conftest import SF001

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF001, con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["branch", "bookings", "mean_price_sgd", "no_show_rate"]
    assert sorted(r.branch for r in rows) == ["Changi", "Orchard"]
    assert sum(r.bookings for r in rows) == 1483
