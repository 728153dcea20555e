"""The life-cycle gate: which event may follow which, checked over whole logs.

A :class:`LifeCycle` is a transition table: the kinds that may start a life, and for each kind
those that may come next. :func:`lifecycle_violations` lists every event that breaks it,
:func:`lifecycle_counts` counts them by kind of violation in one row.

Hot keys: events of one key and day are checked by a window over (key, day), so a key with very
many events is spread over its days. Each day then becomes one row (its first and last event),
and only these rows meet in the window over the key: at most one a calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The kinds of violation, in the order in which they are looked for.
KINDS = ("null_key", "null_day", "unknown_kind", "not_started", "second_start", "after_end", "bad_transition")


@dataclass(frozen=True)
class LifeCycle:
    """``starts``: kinds that may be a key's first event. ``follows``: kind -> kinds that may come
    next. ``ends``: kinds after which only what ``follows`` allows (say, a rehire) may come."""
    starts: frozenset[str]
    follows: Mapping[str, frozenset[str]]
    ends: frozenset[str] = field(default_factory=frozenset)

    def kinds(self) -> list[str]:
        return sorted(self.starts | set(self.follows) | {k for v in self.follows.values() for k in v} | self.ends)

    def allowed(self) -> list[str]:
        """'previous>next' of every allowed pair."""
        return sorted(f"{a}>{b}" for a, bs in self.follows.items() for b in bs)


def _violation(cycle: LifeCycle, prev: Column, kind: Column, first: Column) -> Column:
    known = F.coalesce(kind.isin(*cycle.kinds()), F.lit(False))
    pair = F.concat(prev, F.lit(">"), kind)
    fine = F.coalesce(pair.isin(*cycle.allowed()), F.lit(False)) if cycle.allowed() else F.lit(False)
    starts = kind.isin(*cycle.starts)
    return (F.when(~known, "unknown_kind")
            .when(first, F.when(~starts, "not_started"))
            .when(fine, None)
            .when(starts, "second_start")
            .when(F.coalesce(prev.isin(*cycle.ends), F.lit(False)) if cycle.ends else F.lit(False), "after_end")
            .otherwise("bad_transition"))


def lifecycle_violations(events: DataFrame, cycle: LifeCycle, key: str | Sequence[str], date: str,
                         order: str, kind: str) -> DataFrame:
    """key..., <date>, <order>, previous, <kind>, violation: one row per event that may not
    stand where it stands.

    Events are ordered by day, then ``order``, then kind (so that ties give the same rows on
    every run); repeated events are events of their own. An event is compared with the one
    right before it, allowed or not; an unknown or NULL kind is reported itself, and what
    follows it is a ``bad_transition`` (or a second start). Events without key or day are
    reported as ``null_key`` or ``null_day`` and are no one's predecessor. An empty log has no
    violations. Other columns are dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ev = events.select(*keys, F.col(date).alias("_d"), F.col(order).alias("_o"), F.col(kind).alias("_k"))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    reason = F.when(no_key, "null_key").when(F.col("_d").isNull(), "null_day")
    lost = ev.select("*", F.lit(None).cast("string").alias("_p"), reason.alias("violation")).filter("violation is not null")
    placed = ev.filter(~no_key & F.col("_d").isNotNull())

    day = Window.partitionBy(*keys, "_d").orderBy("_o", "_k")
    whole = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = placed.select("*", F.row_number().over(day).alias("_at"), F.lag("_k").over(day).alias("_p"),
                           F.last("_k").over(whole).alias("_last"))
    later = (inside.filter("_at > 1")
             .withColumn("violation", _violation(cycle, F.col("_p"), F.col("_k"), F.lit(False))))
    life = Window.partitionBy(*keys).orderBy("_d")
    firsts = (inside.filter("_at = 1")
              .select(*keys, "_d", "_o", "_k", F.lag("_last").over(life).alias("_p"), F.row_number().over(life).alias("_at"))
              .withColumn("violation", _violation(cycle, F.col("_p"), F.col("_k"), F.col("_at") == 1)))
    cols = [*keys, "_d", "_o", "_p", "_k", "violation"]
    found = later.select(*cols).unionByName(firsts.select(*cols)).filter("violation is not null").unionByName(lost.select(*cols))
    return found.select(*keys, F.col("_d").alias(date), F.col("_o").alias(order), F.col("_p").alias("previous"),
                        F.col("_k").alias(kind), "violation")


def lifecycle_counts(violations: DataFrame) -> DataFrame:
    """One row with a count per kind of violation, which :func:`strata.operators.gates.enforce` takes."""
    return violations.agg(*[F.count_if(F.col("violation") == k).alias(k) for k in KINDS])
