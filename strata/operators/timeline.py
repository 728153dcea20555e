"""Keeping a stored history right: coalescing, late events, and two time axes.

* :func:`coalesce_versions` -- touching versions of a key with one row hash become one
* :func:`store_history` / :func:`splice_events` / :func:`finish_splice` / :func:`read_history` --
  a history stored by the year its versions end, into which late events are spliced
* :func:`bitemporal` -- what each load knew, as rectangles of valid time by load time
* :func:`known_asof` -- facts joined to the version valid on one day as known on another

Days are closed at both ends and 9999-12-31 is the open end, as in
:mod:`strata.operators.history`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.operators.history import SENTINEL, scd2
from strata.operators.marts import asof
from strata.session import materialize

ENDS = "ends_in"                                           # folder column of a stored history


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _usable(keys: list[str], lo: str, hi: str) -> Column:
    ok = F.coalesce(F.col(lo) <= F.col(hi), F.lit(False))
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def coalesce_versions(versions: DataFrame, key: str | Sequence[str], hash_col: str = "row_hash",
                      valid_from: str = "valid_from", valid_to: str = "valid_to",
                      current: str | None = "is_current") -> DataFrame:
    """Versions with neighbours of equal ``hash_col`` merged (gaps and islands).

    A version opens an island unless it starts the day after the one before it ends and
    has the same hash; a running count of openings numbers the islands, and one aggregate
    closes them. An island keeps the first start, the last end and ``current`` flag, and
    every other column of its first version. Window and aggregate share one shuffle by
    key, and a key has at most one version a day.

    Versions with a NULL key or day, or that end before they start, stay as they are;
    a NULL hash equals another NULL hash. Repeated and overlapping versions never touch,
    so they stay too. An empty table stays empty. Columns keep their names and order;
    none may start with ``_isl``.
    """
    keys = _keys(key)
    w = Window.partitionBy(*keys, "_isl_ok").orderBy(valid_from, valid_to)
    touches = (F.col("_isl_ok") & (F.lag(valid_to).over(w) == F.date_sub(valid_from, 1))
               & F.lag(F.col(hash_col)).over(w).eqNullSafe(F.col(hash_col))
               & F.lag(F.lit(True)).over(w).isNotNull())
    marked = (versions.withColumn("_isl_ok", _usable(keys, valid_from, valid_to))
              .withColumn("_isl_new", (~F.coalesce(touches, F.lit(False))).cast("int"))
              .withColumn("_isl", F.sum("_isl_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    rest = [c for c in versions.columns if c not in (*keys, valid_from, valid_to, current)]
    first = F.min(F.struct(valid_from, valid_to, *rest)).alias("_isl_first")
    last = F.max(F.struct(valid_from, valid_to, *([current] if current else []))).alias("_isl_last")
    out = marked.groupBy(*keys, "_isl_ok", "_isl").agg(first, last)
    return out.select(*[F.col(c) if c in keys else F.col(f"_isl_last.{c}").alias(c) if c in (valid_to, current)
                        else F.col(f"_isl_first.{c}").alias(c) for c in versions.columns])


# ------------------------------------------------------------------ late events

def _with_ends(versions: DataFrame) -> DataFrame:
    return versions.withColumn(ENDS, F.coalesce(F.year("valid_to"), F.lit(0)))


def store_history(versions: DataFrame, path: str) -> str:
    """Write a history in folders by the year its versions end (9999: open ones).

    One row without a key, in folder 0, keeps the columns readable where there is no version.
    """
    blank = versions.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in versions.schema.fields])
    (_with_ends(versions.unionByName(blank)).hint("rebalance", ENDS).write.mode("overwrite").partitionBy(ENDS).parquet(path))
    return path


def read_history(spark: SparkSession, path: str, key: str | Sequence[str]) -> DataFrame:
    """The versions of a stored history (without the placeholder rows of emptied folders)."""
    rows = spark.read.parquet(path)
    keys = _keys(key)
    return rows.filter(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull()).drop(ENDS)


def unplaced_exits(versions: DataFrame, exits: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Exits of keys without a version: a stored history doesn't hold them, so they must come
    again with the late batch that brings the key's first state event."""
    keys = _keys(key)
    return exits.join(versions.select(*keys).distinct(), keys, "left_anti")


def splice_events(spark: SparkSession, path: str, late: DataFrame, key: str | Sequence[str], date: str,
                  order: str, state: Sequence[str], is_exit: Column | None = None,
                  exits: DataFrame | None = None) -> str:
    """Splice late or corrected events into the history stored at ``path``; returns the folder
    of the staged rows, which :func:`finish_splice` writes.

    A version holds the event that opened it, and a key's last version its exit, so the keys
    of the late batch can be replayed from their stored versions and the batch alone; all
    other keys are not touched. Only folders that lose or gain a version are rewritten: their
    rows of other keys are copied, those of the affected keys replaced. The result equals a
    replay of all events (``scd2`` with one version a day). The order of batches doesn't
    matter: the event with the highest ``order`` of a day wins, whenever it arrives.

    Late events without key or day are left out, as ``scd2`` does; gate them first
    (:func:`strata.operators.history.scd2_rejects`). Repeated events change nothing. An empty
    batch stages nothing. The stored history must come from ``scd2`` without ``rehire``.
    """
    keys = _keys(key)
    state = list(state)
    flag = F.coalesce(is_exit, F.lit(False)) if is_exit is not None else F.lit(False)
    late = late.select(*keys, F.col(date).alias("_d"), F.col(order).alias(order), *state, flag.alias("_x"))
    if exits is not None:
        late = late.unionByName(exits.select(*keys, F.col(date).alias("_d"), F.lit(True).alias("_x")), allowMissingColumns=True)
    for c in [*keys, "_d"]:
        late = late.filter(F.col(c).isNotNull())
    late = materialize(late, "table")
    affected = late.select(*keys).distinct()
    stored = read_history(spark, path, keys)
    before = materialize(stored.join(affected, keys, "left_semi"), "table")
    # the stored versions as events again: an exit is the end of a key's last version
    ends = before.groupBy(*keys).agg(F.max_by("valid_to", "valid_from").alias("_d")).filter(F.col("_d") != F.lit(SENTINEL))
    events = (before.select(*keys, F.col("valid_from").alias("_d"), order, *state, F.lit(False).alias("_x"))
              .unionByName(late)
              .unionByName(ends.select(*keys, "_d", F.lit(True).alias("_x")), allowMissingColumns=True))
    after = materialize(scd2(events, keys, "_d", order, state, is_exit=F.col("_x")).select(*stored.columns), "table")

    one = lambda df, n: _with_ends(df).withColumn("_n", F.lit(n))
    changed = (one(before, -1).unionByName(one(after, 1)).groupBy(*stored.columns, ENDS)
               .agg(F.sum("_n").alias("_n")).filter("_n <> 0").select(ENDS).distinct())
    changed = materialize(changed, "table")                   # a row a year at most
    others = spark.read.parquet(path).join(F.broadcast(changed), ENDS, "left_semi").join(affected, keys, "left_anti")
    others = others.filter(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNotNull())
    fresh = _with_ends(after).join(F.broadcast(changed), ENDS, "left_semi")
    # a folder that would be empty gets one row without a key, or overwriting would keep its old rows
    blank = changed.select(ENDS)
    rows = others.unionByName(fresh).unionByName(blank, allowMissingColumns=True)
    return _write_staged(rows)


def _write_staged(rows: DataFrame) -> str:
    from strata.session import shared_dir
    path = shared_dir(rows.sparkSession, "splice")
    rows.write.parquet(path)
    return path


def finish_splice(spark: SparkSession, path: str, staged: str) -> None:
    """Replace the folders of ``path`` that ``staged`` holds (dynamic partition overwrite).

    The staged rows are whole folders, so this may be repeated after a crash at any point and
    always ends in the same history. Folders that aren't staged keep their files.
    """
    (spark.read.parquet(staged).hint("rebalance", ENDS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(ENDS).parquet(path))


# ------------------------------------------------------------------ two time axes

def bitemporal(loads: DataFrame, key: str | Sequence[str], state: Sequence[str], load: str = "load_day",
               hash_col: str = "row_hash") -> DataFrame:
    """Rectangles of valid time by load time: key..., valid_from, valid_to, known_from,
    known_to, state..., ``hash_col``.

    ``loads`` holds for every load day the whole history as that load knew it (versions that
    don't overlap). A rectangle says which state was valid on its valid days according to
    every load of its load days; the last load is known until 9999-12-31. A key that a load
    doesn't have is not known from that load on.

    The starts and ends of all loads of a key cut its valid time into segments, at most one a
    day on which that key ever changed. Versions start on cuts, so a window carries each one on
    over the segments that it covers: the work is segments times loads of a key, with no join of
    versions with segments. Equal
    states of a segment in consecutive loads are merged along the load axis, and touching
    segments that were known at the same time along the valid axis, both by
    :func:`coalesce_versions`. Versions with a NULL key, day or load take no part; equal rows
    count once. Columns beside those named are dropped.
    """
    keys, state = _keys(key), list(state)
    cols = [*keys, load, "valid_from", "valid_to", *state, hash_col]
    rows = loads.select(*cols).filter(_usable(keys, "valid_from", "valid_to") & F.col(load).isNotNull()).distinct()
    # loads are few (one a day); each is known until the day before the next
    days = rows.select(load).distinct()
    until = days.select(F.col(load), F.coalesce(F.date_sub(F.lead(load).over(Window.orderBy(load)), 1), F.lit(SENTINEL)).alias("known_to"))
    # a day per load is a bounded table; the planner broadcasts it when it is small
    rows = materialize(rows.join(until, load), "table")
    cuts = (rows.select(*keys, F.explode(F.array("valid_from", F.when(F.col("valid_to") < F.lit(SENTINEL), F.date_add("valid_to", 1)))).alias("_cut"))
            .filter("_cut is not null").distinct())
    segments = cuts.select(*keys, "_cut", F.coalesce(F.date_sub(F.lead("_cut").over(Window.partitionBy(*keys).orderBy("_cut")), 1),
                                                     F.lit(SENTINEL)).alias("_cut_to"))
    # every segment of a key in every load that has the key; versions start on cuts and are carried on
    grid = segments.join(rows.select(*keys, load, "known_to").distinct(), keys)
    version = F.struct("valid_to", *state, hash_col).alias("_v")
    starts = rows.select(*keys, load, F.col("valid_from").alias("_cut"), version)
    w = Window.partitionBy(*keys, load).orderBy("_cut").rowsBetween(Window.unboundedPreceding, 0)
    carried = grid.join(starts, [*keys, load, "_cut"], "left").withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    pieces = (carried.filter(F.col("_cut_to") <= F.col("_v.valid_to"))
              .select(*keys, F.col("_cut").alias("valid_from"), F.col("_cut_to").alias("valid_to"),
                      F.col(load).alias("known_from"), "known_to", *[F.col(f"_v.{c}").alias(c) for c in (*state, hash_col)]))
    known = coalesce_versions(pieces, [*keys, "valid_from", "valid_to"], hash_col, "known_from", "known_to", None)
    return coalesce_versions(known, [*keys, "known_from", "known_to"], hash_col, "valid_from", "valid_to", None)


def known_asof(facts: DataFrame, rectangles: DataFrame, key: str | Sequence[str], valid: str, known: str,
               how: str = "inner", bucket: str = "year") -> DataFrame:
    """Each fact with the version valid on its day ``valid`` as known on its day ``known``.

    An equi-join on (key, year of the valid day) with both intervals as residual predicates,
    as in :func:`strata.operators.marts.asof`, whose spans it uses: a fact is compared only with
    the rectangles of its key that touch its year. ``left`` keeps facts without one.
    """
    keys = _keys(key)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    # a number for each fact, written so that both uses of it see the same one
    marked = materialize(facts.withColumn("_fact", F.monotonically_increasing_id()), "table") if how == "left" else facts
    met = asof(marked, rectangles, keys, valid, how="inner", bucket=bucket)
    met = met.filter((F.col("known_from") <= F.col(known)) & (F.col(known) <= F.col("known_to")))
    if how == "inner":
        return met
    extra = [c for c in rectangles.columns if c not in keys]
    found = met.select("_fact", *extra)
    return marked.join(found, "_fact", "left").select(*facts.columns, *extra)
