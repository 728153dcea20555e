"""Every registered query against its DuckDB twin on the smallest tables (sf0.001),
compared the way the driver does: rows, column names, order-free value digest."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from oracle_check import TABLES, digest  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from strata.plans.oracle import SQL  # noqa: E402
from strata.plans.queries import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(REGISTRY)
# Queries whose result on these tables is rightly empty.
MAY_BE_EMPTY = {"duplicate_keys"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:3] == ["o_custkey", "valid_from", "valid_to"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(SQL) == set(REGISTRY)
    assert set(REGISTRY) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert s_rows or name in MAY_BE_EMPTY
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_planted_breaks_are_counted(spark):
    row = REGISTRY["history_invariants"](spark, SF).first()
    assert all(row[c] > 0 for c in ("inverted", "overlaps", "gaps", "multi_current"))
    row = REGISTRY["gate_summary"](spark, SF).first()
    assert all(row[c] > 0 for c in ("null_keys", "duplicate_keys", "bad_date", "null_date"))


def test_fact_queries_scan_lineitem_once_and_keep_every_line(spark):
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    for name in ("fact_events_asof", "obt"):
        df = REGISTRY[name](spark, SF)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("lineitem.parquet") == 1
        assert df.count() == n


def test_source_filter_prunes_folders(spark):
    df = REGISTRY["multi_source_union"](spark, SF)
    plan = df.filter("source = 'view up'")._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan
