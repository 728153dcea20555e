"""Data-quality gates.

A gate has two halves: a lazy DataFrame that *finds* violations (offending rows, or
one profile row of counts) and :func:`enforce`, which reads that single profile
row and raises :class:`QualityError` listing every failed rule at once.

All counts of one table are fused into one aggregate, so a table is scanned once
per gate run instead of once per ``count()``. Uniqueness needs a grouping by key;
it is folded into the same job by aggregating twice (per key, then globally), with
Spark's map-side partial aggregation shrinking duplicate-heavy keys before the
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import not_in_domain


class QualityError(ValueError):
    """Raised by :func:`enforce`; ``violations`` maps rule name -> offending count."""

    def __init__(self, violations: Mapping[str, int]):
        self.violations = dict(violations)
        detail = ", ".join(f"{k}={v}" for k, v in self.violations.items())
        super().__init__(f"data-quality gate failed: {detail}")


def _keys(k: str | Sequence[str]) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def profile(df: DataFrame, rules: Mapping[str, Column],
            key: str | Sequence[str] | None = None) -> DataFrame:
    """One row: ``n_rows`` plus one ``count_if`` per rule; with ``key`` also
    ``null_keys`` and ``duplicate_keys`` (number of key values seen more than once).
    """
    if key is None:
        return df.agg(F.count("*").alias("n_rows"),
                      *[F.count_if(c).alias(n) for n, c in rules.items()])
    keys = _keys(key)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = (df.select(*keys, null_key.alias("_nk"),
                         *[F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()])
               .groupBy(*keys, "_nk")
               .agg(F.count("*").alias("_n"),
                    *[F.count_if(n).alias(n) for n in rules]))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_nk"), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~F.col("_nk") & (F.col("_n") > 1)).alias("duplicate_keys"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rules])


def failures(profile_df: DataFrame, allow: Iterable[str] = ("n_rows",), prefix: str = "",
             require_rows: bool = True) -> dict[str, int]:
    """The non-zero counts of a profile row (reads one row), with ``prefix`` before each
    name; ``empty_input`` if rows are required and there are none."""
    row = profile_df.first()
    values = row.asDict() if row is not None else {}
    bad = {f"{prefix}{k}": int(v) for k, v in values.items() if k not in set(allow) and v}
    if require_rows and not values.get("n_rows", 0):
        bad[f"{prefix}empty_input"] = 1
    return bad


def enforce(profile_df: DataFrame, allow: Iterable[str] = ("n_rows",),
            require_rows: bool = True) -> dict[str, int]:
    """Read the one profile row; raise if any counted rule is non-zero.

    Only that row of integers is brought to the driver.
    """
    row = profile_df.first()
    values = row.asDict() if row is not None else {}
    bad = {k: int(v) for k, v in values.items() if k not in set(allow) and v}
    if require_rows and not values.get("n_rows", 0):
        bad["empty_input"] = 1
    if bad:
        raise QualityError(bad)
    return {k: int(v) for k, v in values.items()}


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values present more than once, with their count ``n``."""
    keys = _keys(key)
    return (df.groupBy(*keys).agg(F.count("*").alias("n"))
            .filter(F.col("n") > 1))


def unknown_values(df: DataFrame, column: str, domain: Iterable[str]) -> DataFrame:
    """Values outside ``domain`` (NULL counts as unknown), with their count ``n``."""
    return (df.filter(not_in_domain(column, domain))
            .groupBy(column).agg(F.count("*").alias("n")))


def interval_violations(df: DataFrame, lo: str, hi: str) -> DataFrame:
    return df.filter(F.col(lo) > F.col(hi))


def start_violations(df: DataFrame, key: str | Sequence[str], type_col: str,
                     order: Sequence[str], start: str) -> DataFrame:
    """Entities without exactly one ``start`` event, or whose first event is not it.

    Output: key..., ``n_start``, ``first_type``. ``min_by`` over a struct of the
    order columns is an aggregate (partial on the map side), not a window.
    """
    keys = _keys(key)
    return (df.groupBy(*keys)
            .agg(F.count_if(F.col(type_col) == F.lit(start)).alias("n_start"),
                 F.min_by(F.col(type_col), F.struct(*order)).alias("first_type"))
            .filter((F.col("n_start") != 1)
                    | ~F.coalesce(F.col("first_type") == F.lit(start), F.lit(False))))


def history_violations(versions: DataFrame, key: str | Sequence[str],
                       valid_from: str = "valid_from", valid_to: str = "valid_to",
                       is_current: str = "is_current") -> DataFrame:
    """One row of invariant breaks of a version table:

    * ``inverted``   -- valid_from > valid_to
    * ``overlaps``   -- a version starting on or before the end of any earlier one
    * ``gaps``       -- a version starting later than the day after every earlier end
      (only a rehire may do that; count them, do not forbid them)
    * ``multi_current`` -- keys with more than one current version

    Inverted versions cover no day, so they take no part in overlaps and gaps. The
    others are first collapsed to one row per (key, valid_from) by an aggregate with a
    map-side step, so the window, which carries the running maximum of the ends, holds
    at most one row per day of a key, whatever the number of its versions.
    """
    keys = _keys(key)
    lo, hi = F.col(valid_from), F.col(valid_to)
    days = (versions.groupBy(*keys, lo.alias("_lo"))
            .agg(F.count_if(lo > hi).alias("_inv"), F.count_if(lo <= hi).alias("_n"),
                 F.max(F.when(lo <= hi, hi)).alias("_hi"), F.count_if(is_current).alias("_cur")))
    w = (Window.partitionBy(*keys).orderBy("_lo")
         .rowsBetween(Window.unboundedPreceding, -1))
    ended = F.max("_hi").over(w)
    real = F.col("_n") > 0
    flagged = days.select(
        *keys, "_inv", "_cur",
        F.when(real, F.col("_n") - 1 + F.coalesce((F.col("_lo") <= ended).cast("bigint"), F.lit(0)))
        .otherwise(0).alias("_ovl"),
        (real & (F.col("_lo") > F.date_add(ended, 1))).alias("_gap"))
    per_key = flagged.groupBy(*keys).agg(
        F.sum("_inv").alias("_inv"), F.sum("_ovl").alias("_ovl"),
        F.count_if("_gap").alias("_gap"), F.sum("_cur").alias("_cur"))
    return per_key.agg(
        F.coalesce(F.sum("_inv"), F.lit(0)).alias("inverted"),
        F.coalesce(F.sum("_ovl"), F.lit(0)).alias("overlaps"),
        F.coalesce(F.sum("_gap"), F.lit(0)).alias("gaps"),
        F.count_if(F.col("_cur") > 1).alias("multi_current"))


def split_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry ``_violations`` (names of the rules they break).

    One projection computes the array; the two outputs are complementary filters
    over it, so every input row lands in exactly one of them.
    """
    names = F.array_compact(F.array(*[
        F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    flagged = df.withColumn("_violations", names)
    bad = flagged.filter(F.size("_violations") > 0)
    good = flagged.filter(F.size("_violations") == 0).drop("_violations")
    return good, bad


def untrimmed_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: for each string column, how many values carry edge spaces."""
    cols = columns or [f.name for f in df.schema.fields
                       if f.dataType.simpleString() == "string"]
    return df.agg(*[F.count_if(F.col(c) != F.trim(F.col(c))).alias(f"untrimmed_{c}")
                    for c in cols])


def row_count_check(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys whose number of rows a step changed: key..., ``n_in``, ``n_out``.

    Empty if every row came out once. Both sides are counted in one aggregate over
    their union, so neither side's count can be answered from the other's.
    """
    keys = _keys(key)
    tagged = (before.select(*keys, F.lit(1).alias("_in"), F.lit(0).alias("_out"))
              .unionByName(after.select(*keys, F.lit(0).alias("_in"), F.lit(1).alias("_out"))))
    return (tagged.groupBy(*keys).agg(F.sum("_in").alias("n_in"), F.sum("_out").alias("n_out"))
            .filter(F.col("n_in") != F.col("n_out")))
