"""Every query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import compare, connect

from __spark_entry__ import entry
from tidebook.checks.oracles import ORACLES
from tidebook.checks.queries import QUERIES


@pytest.fixture(scope="module")
def engine():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engine, name):
    assert compare(spark, engine, name, QUERIES[name], ORACLES[name], SMALL) == []


def test_entry(spark):
    assert entry(spark).count() > 0
