"""Every registered query against its SQL twin in DuckDB."""

from __future__ import annotations

import pytest
from oracle_check import connect, difference

import __spark_entry__ as entry
from bazaarlake.testbed.oracle import REPORTS, oracle
from bazaarlake.testbed.registry import REGISTRY

QUERIES = REGISTRY
ORACLES = {name: oracle(name) for name in REPORTS if name in REGISTRY}


@pytest.fixture(scope="module")
def duck(sf_small):
    return connect(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_small, name):
    assert difference(QUERIES[name](spark, sf_small), duck, ORACLES[name]) is None
