"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from suite.compare import connect, differences, type_differences
from suite.oracles import ORACLES
from suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    rows = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql()[name]
    assert differences(rows, connection.execute(sql)) == []
    assert type_differences(rows, connection.execute(sql)) == []
