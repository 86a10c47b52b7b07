"""Every registered query with SQL against the checking engine on the smallest tables."""

import pytest

from check import compare, connect, types_match
from sparkloom.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) is None
    assert types_match(df, con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship_plan_has_one_shuffle_and_pushed_filters(spark):
    plan = QUERIES["a07_station_rollup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "PushedFilters: [" in plan


def test_top_k_keeps_candidates_only(spark):
    assert "TakeOrderedAndProject" in QUERIES["t02_top_k"](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_latest_n_limits_before_the_shuffle(spark):
    assert "WindowGroupLimit" in QUERIES["w04_latest_n"](spark, SF)._jdf.queryExecution().executedPlan().toString()
