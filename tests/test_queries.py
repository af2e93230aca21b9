"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from siftloom.queries import oracles, registry
from tests.compare import connect, difference
from tests.conftest import SF

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
