"""Reporting lines: the top, the depth and the loops of a manager hierarchy.

Pointer doubling: each key points at an ancestor, and one self-join a round doubles the distance, so
rounds grow with the logarithm of the deepest line. Loops are found by the same rounds:

* a key at depth d has one at depth d - 1 above it, so once a round brings no key to its top, no
  deeper one is left, and every key still under way leads into a loop;
* the keys pointed at from 2^r steps away are those on loops and those with a line of 2^r keys below
  them; once their number stays, only keys on loops are left;
* the smallest key seen on the way stops changing once every window has been round its loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def reporting_lines(edges: DataFrame, key: str, manager: str) -> DataFrame:
    """<key>, <manager>, root, depth, status: one row per key.

    ``status`` is ``line`` (root: the key at the top, depth: steps up to it, 0 for the top itself),
    ``loop`` (the key reports to itself in the end) or ``into_loop``; for these two root is the
    smallest key of the loop and depth NULL.

    A key without manager, or whose manager is no key of the table, is a top. Rows without key play no
    part; of rows that share a key the smallest manager that is not NULL counts. An empty table gives
    no rows. Other columns are ignored.

    Every round is one equi-join with the unique keys, written as a table, so a lost executor costs one
    round at most; only keys still under way are joined, and AQE splits the partition of a manager whom
    a large part of all keys reports to.
    """
    kind = edges.schema[key].dataType
    own = materialize(edges.filter(F.col(key).isNotNull())
                      .groupBy(F.col(key).alias("k")).agg(F.min(F.col(manager).cast(kind)).alias("boss")), "table")
    known = own.select(F.col("k").alias("up"))
    placed = own.join(known, own["boss"] == known["up"], "left").select("k", "boss", "up")
    at = materialize(placed.select("k", "boss", F.coalesce("up", "k").alias("up"), F.col("up").isNull().alias("done"),
                                   F.when(F.col("up").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("steps"),
                                   F.least("k", F.coalesce("up", "k")).alias("least")), "table")
    before = None
    while True:
        open_keys = at.filter(~F.col("done"))
        seen = open_keys.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("up").alias("heads"),
                             F.count_if("changed").alias("changed") if "changed" in at.columns else F.lit(1).alias("changed")).first()
        now = (seen["n"], seen["heads"])
        if not seen["n"] or (now == before and not seen["changed"]):
            break
        before = now
        above = at.select(F.col("k").alias("_k"), F.col("up").alias("_up"), F.col("done").alias("_done"),
                          F.col("steps").alias("_steps"), F.col("least").alias("_least"))
        moved = (open_keys.join(above, F.col("up") == F.col("_k"))
                 .select("k", "boss", F.col("_up").alias("up"), F.col("_done").alias("done"),
                         (F.col("steps") + F.col("_steps")).alias("steps"), F.least("least", "_least").alias("least"),
                         (F.col("_least") < F.col("least")).alias("changed")))
        still = at.filter("done").select("k", "boss", "up", "done", "steps", "least", F.lit(False).alias("changed"))
        at = materialize(still.unionByName(moved), "table")
    stuck = at.filter(~F.col("done"))
    loops = materialize(stuck.join(stuck.select(F.col("up").alias("k")).distinct(), "k", "left_semi")
                        .select(F.col("k").alias("_k"), F.col("least").alias("_root")), "table")
    here = loops.select(F.col("_k").alias("_own"))
    looped = (stuck.join(loops, F.col("up") == F.col("_k")).join(here, F.col("k") == F.col("_own"), "left")
              .select("k", "boss", F.col("_root").alias("root"), F.lit(None).cast("long").alias("depth"),
                      F.when(F.col("_own").isNotNull(), "loop").otherwise("into_loop").alias("status")))
    lines = at.filter("done").select("k", "boss", F.col("up").alias("root"), F.col("steps").alias("depth"), F.lit("line").alias("status"))
    return lines.unionByName(looped).select(F.col("k").alias(key), F.col("boss").alias(manager), "root", "depth", "status")
