"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.oracle import ORACLES
from checks.registry import QUERIES as OWN
from checks.registry import with_utc
from tests.compare import assert_same
from tests.plans import physical

QUERIES = {name: with_utc(query) for name, query in OWN.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    plan = physical(result)
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "Limit ", "Sample", "REPARTITION_BY_NUM"):
        assert unwanted not in plan.replace("WindowGroupLimit", "")
    assert_same(result, sf_dir, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
