"""Gold-layer builders on top of a version table.

* :func:`asof`     -- facts joined to the version alive on the fact's day
* :func:`snapshot` -- counts of versions alive at each month end
* :func:`changes`  -- incoming records classified against the current versions
* :func:`enrich`   -- attributes joined onto versions (left, key-unique side)

No hints are used: dimension joins are left to AQE, which broadcasts a side only
after measuring it below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
keeps a shuffle join whose skewed partitions it can split.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import ascending, month_end_of_index, month_index


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def enrich(versions: DataFrame, attrs: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join of key-unique attributes; never multiplies versions if the
    attribute table passed its uniqueness gate."""
    keys = _keys(key)
    clash = sorted((set(versions.columns) & set(attrs.columns)) - set(keys))
    if clash:
        raise ValueError(f"versions and attributes share non-key columns {clash}")
    return versions.join(attrs, keys, "left")


def first_key_with_versions(versions: DataFrame, key: str, min_versions: int) -> DataFrame:
    """Full history of the smallest key having at least ``min_versions`` versions.

    The chosen key is a global aggregate: exactly one row, so broadcasting it is
    bounded by construction.
    """
    chosen = (versions.groupBy(key).agg(F.count("*").alias("_n"))
              .filter(F.col("_n") >= min_versions)
              .agg(F.min(key).alias(key)))
    return versions.join(F.broadcast(chosen), key)


def asof(facts: DataFrame, versions: DataFrame, key: str | Sequence[str], date: str,
         how: str = "inner", valid_from: str = "valid_from",
         valid_to: str = "valid_to", bucket: str = "year",
         horizon: _dt.date | None = None) -> DataFrame:
    """Join each fact to the version with ``valid_from <= date <= valid_to``.

    Equi-join on (key, year) with the interval as a residual predicate:

    * each version is repeated once per calendar year it covers, but the last bucket is
      the one of ``horizon`` and holds every later day of facts and versions too, so the
      open-ended sentinel never expands;
    * a fact is compared only with the versions of its key that touch its year,
      so a key with a long history costs a handful of comparisons per fact;
    * the (key, year) join key spreads a hot key over many partitions, and AQE
      can still split a hot (key, year) on the fact side.

    ``how`` is "inner" (facts without a version are dropped) or "left" (kept with
    NULL version columns). Versions must not overlap per key (the history gate).
    ``bucket="month"`` trades more version copies for fewer comparisons per fact,
    for histories that change many times a year. ``horizon`` (default: today) changes no
    result, only how far open versions are repeated and how fine late facts are split; a day
    near the last fact is best. Facts and versions are planned once each, and no job runs
    while the join is built. Facts with a NULL key match nothing; with ``left`` they are
    spread over many buckets, since they would otherwise meet in one task.
    """
    keys = _keys(key)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if bucket not in ("year", "month"):
        raise ValueError("bucket must be 'year' or 'month'")
    unit = F.year if bucket == "year" else month_index
    last = F.lit(horizon or _dt.date.today())
    vcols = [c for c in versions.columns if c not in keys]
    clash = sorted(set(vcols) & set(facts.columns))
    if clash:
        raise ValueError(f"facts and versions share non-key columns {clash}; rename one side")
    spans = (versions.withColumn("_yr", F.explode(ascending(
                 unit(F.least(F.col(valid_from), last)), unit(F.least(F.col(valid_to), last)))))
             .select(*keys, "_yr", *[F.col(c).alias(f"_v_{c}") for c in vcols]))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    bucket_of = unit(F.least(F.col(date), last))
    left = facts.withColumn("_yr", F.when(no_key, -1 - F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int"))
                            .otherwise(bucket_of) if how == "left" else bucket_of)
    cond = [left[k] == spans[k] for k in keys] + [
        left["_yr"] == spans["_yr"],
        left[date] >= spans[f"_v_{valid_from}"],
        left[date] <= spans[f"_v_{valid_to}"],
    ]
    out = left.join(spans, cond, how)
    return out.select(*[left[c] for c in facts.columns],
                      *[spans[f"_v_{c}"].alias(c) for c in vcols])


def obt(facts: DataFrame, versions: DataFrame, key: str | Sequence[str], date: str,
        dims: Sequence[tuple[DataFrame, str | Sequence[str]]] = (),
        how: str = "left", horizon: _dt.date | None = None) -> DataFrame:
    """One big table: each fact with the version alive on its day and the
    attributes of every dimension joined onto that version.

    Dimensions are joined to the (smaller) version table first, so the facts are
    shuffled exactly once, by the as-of join.
    """
    wide = versions
    for dim, dkey in dims:
        wide = enrich(wide, dim, dkey)
    return asof(facts, wide, key, date, how=how, horizon=horizon)


def snapshot(versions: DataFrame, lo: _dt.date, hi: _dt.date,
             by: Sequence[str] = (), valid_from: str = "valid_from",
             valid_to: str = "valid_to", name: str = "headcount") -> DataFrame:
    """Versions alive at each month end in [lo, hi], counted per ``by``.

    A version alive on month end ``e`` satisfies ``valid_from <= e <= valid_to``. It adds
    one at its first month end and takes one off after its last: two rows a version,
    however long it lives, summed per (group, month) with a map-side step. A running sum
    over that small table gives the counts, and each one is repeated up to the month of
    the next change. No range join, and the open-ended sentinel never expands.
    """
    vf, vt = F.col(valid_from), F.least(F.col(valid_to), F.lit(hi))
    last = F.when(F.last_day(vt) == vt, month_index(vt)).otherwise(month_index(vt) - 1)
    lives = (versions.filter(vf <= F.lit(hi))
             .select(*by, F.greatest(month_index(vf), month_index(F.lit(lo))).alias("_a"),
                     last.alias("_z"))
             .filter(F.col("_a") <= F.col("_z")))
    steps = (lives.select(*by, F.inline(F.array(
        F.struct(F.col("_a").alias("_m"), F.lit(1).alias("_d")),
        F.struct((F.col("_z") + 1).alias("_m"), F.lit(-1).alias("_d")))))
        .groupBy(*by, "_m").agg(F.sum("_d").alias("_d")))
    w = Window.partitionBy(*by).orderBy("_m")
    counts = (steps.select(*by, "_m", F.sum("_d").over(w).alias(name), F.lead("_m").over(w).alias("_next"))
              .filter(F.col(name) > 0))
    return (counts.withColumn("_i", F.explode(ascending(F.col("_m"), F.col("_next") - 1)))
            .select(month_end_of_index("_i").alias("month_end"), *by, name))


def _classify(in_cur, in_inc, h_cur, h_inc):
    return (F.when(~in_cur, "new").when(~in_inc, "gone")
            .when(h_cur.eqNullSafe(h_inc), "unchanged").otherwise("changed"))


def changes(current: DataFrame, incoming: DataFrame, key: str | Sequence[str],
            hash_col: str = "row_hash") -> DataFrame:
    """Classify keys as new / changed / unchanged / gone by comparing hashes.

    Both sides are cut to (key, hash), tagged and unioned, then grouped by key:
    the same answer as a full outer join on key, but as one aggregate with a
    map-side partial step (a key repeated on either side is pre-combined before
    the shuffle, and no side has to be sorted for a merge).
    """
    keys = _keys(key)
    cur = current.select(*keys, F.col(hash_col).alias("_h_cur"),
                         F.lit(None).cast("string").alias("_h_inc"), F.lit(1).alias("_c"),
                         F.lit(0).alias("_i"))
    inc = incoming.select(*keys, F.lit(None).cast("string").alias("_h_cur"),
                          F.col(hash_col).alias("_h_inc"), F.lit(0).alias("_c"),
                          F.lit(1).alias("_i"))
    g = (cur.unionByName(inc).groupBy(*keys)
         .agg(F.max("_h_cur").alias("current_hash"), F.max("_h_inc").alias("incoming_hash"),
              (F.max("_c") == 1).alias("_in_cur"), (F.max("_i") == 1).alias("_in_inc")))
    return g.select(*keys, _classify(F.col("_in_cur"), F.col("_in_inc"), F.col("current_hash"),
                                     F.col("incoming_hash")).alias("change"),
                    "current_hash", "incoming_hash")


def changes_between(versions: DataFrame, key: str | Sequence[str], then: _dt.date,
                    now: _dt.date, hash_col: str = "row_hash",
                    valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """:func:`changes` between the states alive on two days of one version table.

    One pass: versions alive on either day are grouped by key (at most one alive
    per day for a valid history). The grouping needs the key partitioning the
    history window already produced, so it adds no shuffle of its own.
    """
    keys = _keys(key)
    vf, vt = F.col(valid_from), F.col(valid_to)
    at_then = (vf <= F.lit(then)) & (F.lit(then) <= vt)
    at_now = (vf <= F.lit(now)) & (F.lit(now) <= vt)
    g = (versions.filter(at_then | at_now).groupBy(*keys)
         .agg(F.max(F.when(at_then, F.col(hash_col))).alias("current_hash"),
              F.max(F.when(at_now, F.col(hash_col))).alias("incoming_hash"),
              F.max(at_then).alias("_in_cur"), F.max(at_now).alias("_in_inc")))
    return g.select(*keys, _classify(F.col("_in_cur"), F.col("_in_inc"), F.col("current_hash"),
                                     F.col("incoming_hash")).alias("change"),
                    "current_hash", "incoming_hash")
