"""Every named query against its DuckDB statement."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from rollbook import queries as named

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_statement():
    assert set(named.NAMED) <= set(contract.queries())
    assert set(named.NAMED) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(named.NAMED))
def test_query_matches_statement(spark, con, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, con, contract.oracle_sql()[name]) == []


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert len(frame.columns) == 73
    assert frame.count() > 0
