"""Driver contract: every registered query equals its DuckDB oracle on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from skillgrid.plans.oracle import ORACLE_SQL
from skillgrid.plans.registry import QUERIES
from skillgrid.plans.verify import compare, duckdb_connection

from .conftest import SF_ORACLE, SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def ducks():
    return {sf: duckdb_connection(sf) for sf in (SF_SMALL, SF_ORACLE)}


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.queries())
    assert len(NAMES) >= 42


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, ducks, name, sf):
    got = QUERIES[name](spark, sf).toPandas()
    want = ducks[sf].execute(ORACLE_SQL[name]).df()
    result = compare(name, got, want)
    assert result.ok, result.detail


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["publication_month", "skill", "mentions", "ads", "share_of_ads"]
    assert df.count() > 0
