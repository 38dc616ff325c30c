from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import connect, difference
from lakejobs.plans.oracle import oracle
from lakejobs.plans.queries import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(oracle())
    assert set(oracle()) <= set(entry.oracle_sql())
    assert set(all_queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, con, name):
    count, problem = difference(spark, con, SF, name, oracle()[name])
    assert problem is None and count > 0
