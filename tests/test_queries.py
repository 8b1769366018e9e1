"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    notes, *_ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert not notes, notes


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 8
