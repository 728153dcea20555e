"""Event log -> versioned (SCD2) history.

Each state-bearing event opens a version ``[valid_from, valid_to]`` (closed, both
ends inclusive). A version ends the day before the next version starts; the last
one ends on the entity's exit date, else on the open-ended sentinel 9999-12-31.

Plan shape (chosen for skew, not only for speed):

1. State events are collapsed to one row per (key, day) with ``max_by`` on the
   event order. The aggregate has a map-side partial step (sort-based, because
   the carried state is variable-width), so a hot key or a hot (key, day) is
   shrunk before it is shuffled and memory stays bounded (it spills, never OOMs).
2. Exit events are reduced to distinct (key, day) rows the same way.
3. One window per key over the union computes ``lead`` and the last exit in a
   single sort. After step 1 a key holds at most one row per calendar day per
   kind, so the window's largest partition is bounded by the calendar span of the
   log, never by how many events one key has.

``same_day="fail"`` keeps every dated event of a known key: all but the one that
opens a day's version get ``valid_to = day - 1`` (an inverted interval, which the
interval gate reports), ties on (key, day, order) included. Equal events are counted
first, and the day's winner takes one off its count, so no group is ever gathered in
one task.

Events without a day or without a key can open or close nothing. :func:`scd2_rejects`
returns them, so that versions, exits and rejects together are all events.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the open-ended end date of a current version.
SENTINEL = _dt.date(9999, 12, 31)


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _prepared(events: DataFrame, keys: list[str], date: str, order: str,
              state: list[str], is_exit: Column | None) -> DataFrame:
    flag = F.coalesce(is_exit, F.lit(False)) if is_exit is not None else F.lit(False)
    return events.select(*keys, F.col(date).alias("_d"), F.col(order).alias("_o"),
                         *state, flag.alias("_x"))


def _placeable(ev: DataFrame, keys: list[str], day: str = "_d") -> Column:
    """True for events that can take part in a history: day and key are there."""
    ok = F.col(day).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def _state_days(ev: DataFrame, keys: list[str], state: list[str]) -> DataFrame:
    """Last state event of each (key, day), by event order, then by its state (so that
    ties give the same version on every run)."""
    st = ev.filter(~F.col("_x")).filter(_placeable(ev, keys))
    return (st.groupBy(*keys, "_d").agg(F.max(F.struct("_o", *state)).alias("_last"))
            .select(*keys, "_d", "_last.*"))


def _exit_days(ev: DataFrame, keys: list[str], date: str,
               exits: DataFrame | None) -> DataFrame:
    xs = ev.filter(F.col("_x")).select(*keys, "_d")
    if exits is not None:
        xs = xs.unionByName(exits.select(*keys, F.col(date).alias("_d")))
    return xs.filter(_placeable(xs, keys)).dropDuplicates([*keys, "_d"])


def scd2(events: DataFrame, key: str | Sequence[str], date: str, order: str,
         state: Sequence[str], is_exit: Column | None = None,
         exits: DataFrame | None = None, same_day: str = "last",
         rehire: bool = False, sentinel: _dt.date = SENTINEL) -> DataFrame:
    """Replay an event log into versions.

    events   -- one row per event carrying the full state after it
    key      -- business key column(s)
    date     -- DateType column: the day the event takes effect
    order    -- tie-breaker inside a day (e.g. the event id); the last one wins
    state    -- tracked columns copied onto the version
    is_exit  -- Column, true for events that close the entity (they open nothing)
    exits    -- optional extra exits as a DataFrame of (key..., date)
    same_day -- "last": keep the last event of a day; "fail": keep all, the other
                same-day events get an inverted interval (reported by the gate)
    rehire   -- False: an exit closes only the last version (reference rule);
                True: an exit closes whatever version precedes it and a later
                state event reopens the entity

    Output: key..., valid_from, valid_to, is_current, <order>, state...
    """
    if same_day not in ("last", "fail"):
        raise ValueError("same_day must be 'last' or 'fail'")
    keys, state = _as_list(key), list(state)
    ev = _prepared(events, keys, date, order, state, is_exit)
    days = _state_days(ev, keys, state).withColumn("_x", F.lit(False))
    xdays = _exit_days(ev, keys, date, exits).withColumn("_x", F.lit(True))
    both = days.unionByName(xdays, allowMissingColumns=True)

    end = F.lit(sentinel)
    if rehire:
        w = Window.partitionBy(*keys).orderBy("_d", "_x")
        nxt, nxt_x = F.lead("_d").over(w), F.lead("_x").over(w)
        valid_to = (F.when(nxt.isNull(), end).when(nxt_x, nxt)
                    .otherwise(F.date_sub(nxt, 1)))
    else:
        # exits sort after every state day, so lead() of a state row is the next
        # state day, or an exit for the last one; the last exit is a whole-frame max
        w = Window.partitionBy(*keys).orderBy("_x", "_d")
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        nxt, nxt_x = F.lead("_d").over(w), F.lead("_x").over(w)
        last_exit = F.max(F.when(F.col("_x"), F.col("_d"))).over(whole)
        valid_to = (F.when(nxt.isNotNull() & ~nxt_x, F.date_sub(nxt, 1))
                    .otherwise(F.coalesce(last_exit, end)))

    versions = (both.select("*", valid_to.alias("valid_to"))
                .filter(~F.col("_x"))
                .select(*keys, F.col("_d").alias("valid_from"), "valid_to",
                        (F.col("valid_to") == end).alias("is_current"),
                        F.col("_o").alias(order), *state))
    if same_day == "fail":
        st = ev.filter(~F.col("_x")).filter(_placeable(ev, keys))
        equal = st.groupBy(*keys, "_d", "_o", *state).agg(F.count("*").alias("_n"))
        won = (st.groupBy(*keys, "_d").agg(F.max(F.struct("_o", *state)).alias("_won")))
        rest = F.col("_n") - F.struct("_o", *state).eqNullSafe(F.col("_won")).cast("int")
        earlier = (equal.join(won, [*keys, "_d"]).withColumn("_n", rest)
                   .filter(F.col("_n") > 0)
                   .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
                   .select(*keys, F.col("_d").alias("valid_from"),
                           F.date_sub("_d", 1).alias("valid_to"),
                           F.lit(False).alias("is_current"),
                           F.col("_o").alias(order), *state))
        versions = versions.unionByName(earlier)
    return versions


def scd2_rejects(events: DataFrame, key: str | Sequence[str], date: str, order: str,
                 state: Sequence[str], is_exit: Column | None = None,
                 exits: DataFrame | None = None) -> DataFrame:
    """Events and exits that :func:`scd2` cannot place: no day, or a NULL key column.

    Output: key..., <date>, <order>, state..., ``is_exit``, ``reason`` ("null_key" or
    "null_day"). Empty for a log that passed its gates.
    """
    keys, state = _as_list(key), list(state)
    ev = _prepared(events, keys, date, order, state, is_exit)
    if exits is not None:
        extra = exits.select(*keys, F.col(date).alias("_d")).withColumn("_x", F.lit(True))
        ev = ev.unionByName(extra, allowMissingColumns=True)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    return (ev.filter(~_placeable(ev, keys))
            .select(*keys, F.col("_d").alias(date), F.col("_o").alias(order), *state,
                    F.col("_x").alias("is_exit"),
                    F.when(no_key, "null_key").otherwise("null_day").alias("reason")))


def next_event(events: DataFrame, key: str | Sequence[str], date: str, order: str,
               state: Sequence[str] = (), sentinel: _dt.date = SENTINEL) -> DataFrame:
    """The ``lead`` step alone: per (key, day) the next state day and the day before it.

    Output: key..., valid_from, next_from, valid_to (next_from - 1, or the sentinel).
    Exits are not applied here; see :func:`scd2`.
    """
    keys, state = _as_list(key), list(state)
    ev = _prepared(events, keys, date, order, state, None)
    w = Window.partitionBy(*keys).orderBy("_d")
    nxt = F.lead("_d").over(w)
    return (_state_days(ev, keys, state)
            .select(*keys, F.col("_d").alias("valid_from"), nxt.alias("next_from"),
                    F.col("_o").alias(order), *state)
            .withColumn("valid_to", F.coalesce(F.date_sub("next_from", 1), F.lit(sentinel))))


def current(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col("is_current"))


def as_of(versions: DataFrame, day: Column) -> DataFrame:
    """Versions alive on ``day`` (at most one per key for a valid history)."""
    return versions.filter((F.col("valid_from") <= day) & (day <= F.col("valid_to")))


def snapshot_profile(history: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                     load_date: _dt.date) -> DataFrame:
    """One row of what :func:`apply_snapshot` cannot merge: NULL and duplicate keys of
    the snapshot, and versions that start after the load day (a load out of order)."""
    from strata.operators.gates import profile
    keys = _as_list(key)
    snap = profile(incoming.select(*keys), {}, key=keys).select(
        F.col("null_keys"), F.col("duplicate_keys"), F.lit(0).cast("bigint").alias("later_versions"))
    late = history.agg(F.lit(0).cast("bigint").alias("null_keys"),
                       F.lit(0).cast("bigint").alias("duplicate_keys"),
                       F.count_if(F.col("valid_from") > F.lit(load_date)).alias("later_versions"))
    return snap.unionByName(late).agg(*[F.sum(c).alias(c) for c in snap.columns])


def apply_snapshot(history: DataFrame, incoming: DataFrame, key: str | Sequence[str],
                   tracked: Sequence[str], load_date: _dt.date,
                   sentinel: _dt.date = SENTINEL, hash_col: str = "row_hash",
                   gate: bool = True, reopen: bool = False) -> DataFrame:
    """Merge a full snapshot of the source into a version table (incremental SCD2).

    Per key, the version alive on ``load_date`` (an exit that lies after it counts as
    still open) is compared with the incoming row by ``row_hash``:

    * equal          -> nothing changes (no new version);
    * different      -> the version ends on ``load_date - 1`` and a new one starts on
      ``load_date`` with the old one's end, so a planned exit stays planned;
    * only incoming  -> a new open-ended version starts on ``load_date``;
    * only history   -> the version ends on ``load_date - 1``.

    A version that started on ``load_date`` itself never lived a day, so a corrected
    snapshot of the same day replaces it instead of closing it.

    With ``reopen`` a version that ended on ``load_date - 1`` and equals the incoming row
    goes on instead of being followed by an equal one: a corrected load that restores
    yesterday's state leaves one version, as if the wrong load had never been. If no two
    touching versions of a key shared a hash before, none do after. The neighbour comes
    from one window over the key, whose partitioning the join then uses.

    One full outer join on the key does all of it: a history that is still partitioned
    by key (as :func:`scd2` leaves it) is read once and not shuffled again. With
    ``gate`` the snapshot's keys and the load order are checked first
    (:func:`snapshot_profile`); without it the caller vouches for them.

    ``history`` needs key..., valid_from, valid_to, is_current, tracked...,
    ``hash_col``; the output has exactly those columns.
    """
    from strata.functions import md5_of
    from strata.operators.gates import enforce
    keys, tracked = _as_list(key), list(tracked)
    if gate:
        enforce(snapshot_profile(history, incoming, keys, load_date), require_rows=False)
    cols = [*keys, "valid_from", "valid_to", "is_current", *tracked, hash_col]
    day = F.lit(load_date)
    alive = (F.col("valid_from") <= day) & (F.col("valid_to") >= day)
    old = history.select(*cols).withColumn("_alive", alive)
    if reopen:
        w = Window.partitionBy(*keys).orderBy("valid_from", "valid_to")
        ended = F.col("valid_to") == F.date_sub(day, 1)
        before = F.lag(F.struct(*cols)).over(w)
        next_from = F.lead("valid_from").over(w)
        old = (old.select("*", before.alias("_before"), next_from.alias("_next_from"))
               # a version that today's one follows travels with it
               .filter(~(ended & F.coalesce(F.col("_next_from") == day, F.lit(False))))
               .withColumn("_asleep", ended & F.col("_next_from").isNull())
               .withColumn("_before", F.when((F.col("valid_from") == day) & (F.col("_before.valid_to") == F.date_sub(day, 1)),
                                             F.col("_before"))).drop("_next_from"))
    else:
        old = old.withColumns({"_asleep": F.lit(False), "_before": F.lit(None).cast(history.select(*cols).schema)})
    inc = incoming.select(*[F.col(c).alias(f"_i_{c}") for c in [*keys, *tracked]],
                          md5_of(tracked).alias("_i_hash")).alias("i")
    cond = F.col("_alive") | F.col("_asleep")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_i_{k}"))
    both = old.alias("h").join(inc, cond, "full_outer")
    is_old, is_inc = F.col("_alive").isNotNull(), F.col("_i_hash").isNotNull()
    asleep = F.coalesce("_asleep", F.lit(False))
    touched = is_old & F.col("_alive") & ~(is_inc & F.col(hash_col).eqNullSafe(F.col("_i_hash")))
    replaced = touched & (F.col("valid_from") == day)
    equals_before = F.coalesce(is_inc & (F.col(f"_before.{hash_col}") == F.col("_i_hash")), F.lit(False))
    wakes = asleep & is_inc & F.col(hash_col).eqNullSafe(F.col("_i_hash"))
    closed_to = F.date_sub(day, 1)
    kept = F.struct(*keys, "valid_from",
                    F.when(touched, closed_to).when(wakes, F.lit(sentinel)).otherwise(F.col("valid_to")).alias("valid_to"),
                    F.when(touched, F.lit(False)).when(wakes, F.lit(True)).otherwise(F.col("is_current")).alias("is_current"),
                    *tracked, hash_col)
    end = F.when(asleep, F.lit(sentinel)).otherwise(F.coalesce(F.col("valid_to"), F.lit(sentinel)))
    opened = F.struct(*[F.col(f"_i_{k}").alias(k) for k in keys], day.alias("valid_from"), end.alias("valid_to"),
                      (end == F.lit(sentinel)).alias("is_current"), *[F.col(f"_i_{c}").alias(c) for c in tracked],
                      F.col("_i_hash").alias(hash_col))
    goes_on = replaced & equals_before
    earlier = F.struct(*[F.col(f"_before.{k}").alias(k) for k in keys], F.col("_before.valid_from").alias("valid_from"),
                       F.when(goes_on, F.col("valid_to")).otherwise(F.col("_before.valid_to")).alias("valid_to"),
                       F.when(goes_on, F.col("is_current")).otherwise(F.col("_before.is_current")).alias("is_current"),
                       *[F.col(f"_before.{c}").alias(c) for c in [*tracked, hash_col]])
    opens = is_inc & ~goes_on & (touched | ~is_old | (asleep & ~wakes))
    rows = F.array_compact(F.array(F.when(F.col("_before").isNotNull(), earlier), F.when(is_old & ~replaced, kept),
                                   F.when(opens, opened)))
    return both.select(F.inline(rows)).select(*cols)
