"""Invariants on the largest tables (sf0.1): the history is well formed and the
as-of join never multiplies fact rows."""

import pytest
from pyspark.sql import functions as F

from strata.operators import gates, marts
from strata.plans.catalog import order_facts, order_history

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def history(spark):
    return order_history(spark, SF)


def test_history_is_disjoint_with_one_current_at_most(history):
    row = gates.history_violations(history, "o_custkey").first().asDict()
    assert row == {"inverted": 0, "overlaps": 0, "gaps": 0, "multi_current": 0}


def test_asof_left_keeps_every_fact_once(spark, history):
    facts = order_facts(spark, SF)
    out = marts.asof(facts, history, "o_custkey", "ship_date", how="left")
    n_facts = facts.count()
    agg = out.agg(F.count("*").alias("n"),
                  F.count_if(F.col("valid_from").isNotNull()).alias("matched")).first()
    assert agg["n"] == n_facts
    inner = marts.asof(facts, history, "o_custkey", "ship_date").count()
    assert inner == agg["matched"]
