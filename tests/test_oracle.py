"""Every registered query against its SQL; queries without SQL must give rows."""

import pytest

import __spark_entry__ as entry
from riskmart.plans.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert differences(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "value", "transactions", "positives", "rate_pct", "amount_total", "amount_positive"]
    assert df.count() > 0
