"""Every query with an SQL counterpart gives what DuckDB gives; the others give rows."""

import pytest

import __spark_entry__ as entry
import compare
from conftest import MEDIUM

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(MEDIUM)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, MEDIUM), duck, ORACLES[name]) is None


def test_entry(spark):
    rates = {r.gateway_id: round(r.anomaly_rate, 2) for r in entry.entry(spark).collect()}
    assert rates == {"gw_0": 10.62, "gw_1": 10.34, "gw_2": 8.65, "gw_3": 13.11}
