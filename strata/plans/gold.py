"""Gold layer over the input tables: versions, dimensions, facts, snapshot, OBT.

:func:`build` writes every Gold table once. The version history is materialised
first (written as a table) because four tables read it; each later table then
starts from stored data, so neither a consumer nor a retried task recomputes the
history's shuffles. The OBT is written, not recomputed per reader.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.operators import calendar, gates, marts
from strata.operators.history import scd2_rejects
from strata.operators.keys import with_keys
from strata.plans.catalog import (FACT_HORIZON, STATE_COLUMNS, customer_dim, holiday_feed, order_facts,
                                  order_history, order_log)
from strata.sources.files import publish, read_table, write_table


def build(spark: SparkSession, sf_dir: str, warehouse: str,
          partition_facts: bool = True) -> dict[str, str]:
    """Write the Gold tables into a folder of this run, gate them, and publish them
    together (:func:`strata.sources.files.publish`); returns {table: path}.

    The facts are joined once, by the as-of join against the wide versioned
    dimension, and written as the OBT; the narrow fact table is then a column
    projection of the written OBT (Parquet reads only the projected columns).

    With ``partition_facts`` the OBT and the fact table are partitioned by ship
    month, so date-bounded readers prune whole folders. Rows are first rebalanced
    on that month (the ``rebalance`` hint: hash by month, then AQE splits a large
    month into advisory-sized slices and merges small ones; no sampling pass over
    the join, unlike a range repartition), so each write task holds one month and
    writes one file, instead of every task writing a file into every month. That
    rebalance is the one extra shuffle of the OBT; ``partition_facts=False`` skips it.
    """
    from strata.plans import queries as q
    run_id = uuid.uuid4().hex[:12]
    base = f"{warehouse.rstrip('/')}/_runs/{run_id}/gold"
    paths: dict[str, str] = {}

    def put(name, df):
        paths[name] = write_table(df, f"{base}/{name}")
        return read_table(spark, paths[name])

    # events that can open no version must not get lost
    rejects = scd2_rejects(order_log(spark, sf_dir), "o_custkey", "event_date", "o_orderkey", STATE_COLUMNS)
    gates.enforce(rejects.agg(F.count_if(F.col("reason") == "null_key").alias("null_key_events"),
                              F.count_if(F.col("reason") == "null_day").alias("null_day_events")), require_rows=False)
    versions = put("employee_versions",
                   with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS))
    # gate the written history before anything is derived from it
    gates.enforce(gates.history_violations(versions, "o_custkey"), allow=("gaps",),
                  require_rows=False)
    customers = customer_dim(spark, sf_dir)
    gates.enforce(gates.profile(customers.select("o_custkey"), {}, key="o_custkey"), require_rows=False)
    dim = put("dim_customer_versioned", marts.enrich(versions, customers, "o_custkey"))
    put("dim_date", calendar.dim_date(
        spark, q.DIM_LO, q.DIM_HI,
        calendar.shape_calendar(holiday_feed(spark, sf_dir), q.DIM_LO, q.DIM_HI),
        q.DIM_COUNTRY))
    put("fact_headcount_snapshot",
        marts.snapshot(versions, q.SNAPSHOT_LO, q.SNAPSHOT_HI, by=["o_orderstatus"]))
    obt = marts.obt(order_facts(spark, sf_dir), dim, "o_custkey", "ship_date", how="left",
                    horizon=FACT_HORIZON)
    parts: list[str] = []
    if partition_facts:
        obt = (obt.withColumn("ship_month", F.date_format("ship_date", "yyyy-MM"))
               .hint("rebalance", "ship_month"))
        parts = ["ship_month"]
    paths["obt"] = write_table(obt, f"{base}/obt", partition_by=parts)
    obt = read_table(spark, paths["obt"])
    paths["fact_lines_asof"] = write_table(
        obt.select("l_orderkey", "l_linenumber", "o_custkey", "ship_date", "version_sk",
                   *parts), f"{base}/fact_lines_asof", partition_by=parts)
    publish(spark, warehouse, run_id, {f"gold.{k}": p for k, p in paths.items()})
    return paths
