"""Registered queries: one per operator of the survey, over the input tables.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and is registered under the name
used by ``__spark_entry__.queries()``; its DuckDB twin lives in
:mod:`strata.plans.oracle` under the same name. Every query reads whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import md5_of, no_digit, not_in_domain, parse_date
from strata.operators import calendar, clean as cleaning, gates, lifecycle, marts, nested
from strata.operators.history import SENTINEL, as_of, current
from strata.operators.keys import with_keys
from strata.operators.lifecycle import LifeCycle
from strata.operators.ordering import with_position
from strata.plans.catalog import (FACT_HORIZON, STATE_COLUMNS, customer_dim, customer_exits, customer_nested,
                                  customer_text, events_text, FACT_HORIZON, holiday_feed, order_facts,
                                  order_history, order_log, orders_text, page_params, table)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --------------------------------------------------------------------------- history

@query
def scd2_history(spark, sf_dir):
    return order_history(spark, sf_dir)


@query
def next_event(spark, sf_dir):
    from strata.operators import history
    return history.next_event(order_log(spark, sf_dir), key="o_custkey",
                              date="event_date", order="o_orderkey", state=STATE_COLUMNS)


@query
def current_versions(spark, sf_dir):
    return current(order_history(spark, sf_dir))


@query
def versions_per_key(spark, sf_dir):
    return (order_history(spark, sf_dir).groupBy("o_custkey")
            .agg(F.count("*").alias("n_versions"),
                 F.count_if("is_current").alias("n_current")))


@query
def interval_violations(spark, sf_dir):
    from strata.operators.gates import interval_violations as inverted
    strict = order_history(spark, sf_dir, same_day="fail")
    return inverted(strict, "valid_from", "valid_to").select(
        "o_custkey", "o_orderkey", "valid_from", "valid_to")


@query
def history_invariants(spark, sf_dir):
    """The order history with planted breaks: key % 20 = 0 a second, current version of 400
    days from the same start, key % 21 = 0 an inverted one, key % 22 = 0 one that starts 100
    days after a closed one's end."""
    v = order_history(spark, sf_dir).select("o_custkey", "valid_from", "valid_to", "is_current")
    k, lo, hi = F.col("o_custkey"), F.col("valid_from"), F.col("valid_to")
    spans = F.array_compact(F.array(
        F.struct(lo.alias("valid_from"), hi.alias("valid_to"), "is_current"),
        F.when(k % 20 == 0, F.struct(lo.alias("valid_from"), F.date_add(lo, 400).alias("valid_to"),
                                     F.lit(True).alias("is_current"))),
        F.when(k % 21 == 0, F.struct(lo.alias("valid_from"), F.date_sub(lo, 5).alias("valid_to"),
                                     F.lit(False).alias("is_current"))),
        F.when((k % 22 == 0) & (hi < F.lit(SENTINEL)), F.struct(
            F.date_add(hi, 100).alias("valid_from"), F.date_add(hi, 200).alias("valid_to"),
            F.lit(False).alias("is_current")))))
    return gates.history_violations(v.select("o_custkey", F.inline(spans)), "o_custkey")


@query
def surrogate_key(spark, sf_dir):
    return (with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS)
            .select("o_custkey", "valid_from", "version_sk"))


@query
def row_hash(spark, sf_dir):
    return (with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS)
            .select("o_custkey", "valid_from", *STATE_COLUMNS, "row_hash"))


def _customer_attrs(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")


@query
def scd2_enriched(spark, sf_dir):
    from strata.operators.marts import enrich
    return (enrich(order_history(spark, sf_dir), _customer_attrs(spark, sf_dir), "o_custkey")
            .select("o_custkey", "valid_from", "valid_to", "is_current", *STATE_COLUMNS,
                    "c_name", "c_mktsegment"))


@query
def first_multi_version_key(spark, sf_dir):
    from strata.operators.marts import first_key_with_versions
    return first_key_with_versions(order_history(spark, sf_dir), "o_custkey", 3).select(
        "o_custkey", "valid_from", "valid_to", "is_current", "o_orderkey", *STATE_COLUMNS)


# --------------------------------------------------------------------------- marts
# The snapshot window, the as-of dates of the change comparison, the
# calendar window and the date dimension's span.
SNAPSHOT_LO, SNAPSHOT_HI = dt.date(1995, 1, 1), dt.date(2001, 8, 31)
CHANGE_CURRENT, CHANGE_INCOMING = dt.date(2000, 12, 31), dt.date(2001, 6, 30)
WINDOW_LO, WINDOW_HI = dt.date(1996, 1, 1), dt.date(1996, 6, 30)
DIM_LO, DIM_HI = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
DIM_COUNTRY = "O"


@query
def fact_events_asof(spark, sf_dir):
    out = marts.asof(order_facts(spark, sf_dir), order_history(spark, sf_dir),
                     "o_custkey", "ship_date", how="left", horizon=FACT_HORIZON)
    return out.select("l_orderkey", "l_linenumber", "o_custkey", "ship_date",
                      "valid_from", "valid_to", "o_orderstatus", "o_orderpriority")


@query
def headcount_snapshot(spark, sf_dir):
    return marts.snapshot(order_history(spark, sf_dir), SNAPSHOT_LO, SNAPSHOT_HI,
                          by=["o_orderstatus"])


@query
def headcount_movements(spark, sf_dir):
    """Entries, transfers and exits a month by status and segment, each of them, and in total."""
    from strata.operators.movements import headcount_movements as movements
    segments = _customer_attrs(spark, sf_dir).select("o_custkey", "c_mktsegment")
    versions = marts.enrich(order_history(spark, sf_dir), segments, "o_custkey")
    return movements(versions, "o_custkey", SNAPSHOT_LO, SNAPSHOT_HI, levels=[
        ("o_orderstatus", "c_mktsegment"), ("o_orderstatus",), ("c_mktsegment",), ()])


@query
def reporting_lines(spark, sf_dir):
    """Who reports to whom on 2000-06-30, over customers with a version alive on that day. The manager
    follows from key and state: key % 40 = 0 -> key + 1 and key % 40 = 1 -> key - 1 (planted loops);
    status 'F' -> key - 1 (long lines), 'O' -> half the key, else a third of it."""
    from strata.operators.reporting import reporting_lines as lines
    k = F.col("o_custkey")
    boss = (F.when(k % 40 == 0, k + 1).when(k % 40 == 1, k - 1).when(F.col("o_orderstatus") == "F", k - 1)
            .when(F.col("o_orderstatus") == "O", F.floor(k / 2)).otherwise(F.floor(k / 3)))
    alive = as_of(order_history(spark, sf_dir), F.lit(dt.date(2000, 6, 30)))
    return lines(alive.select("o_custkey", boss.cast("long").alias("manager")), "o_custkey", "manager")


@query
def namesake_customers(spark, sf_dir):
    """Customers whose names are equal or one slip apart. Names are letters drawn from the key's hash;
    planted: key % 10 = 7 all have one name, key % 50 = 8 it with two letters swapped; key % 10 = 3 has a
    second key (+ 10^9) with a slip, key % 10 = 4 one (+ 2 * 10^9) in capitals with more spaces."""
    from strata.operators.namesakes import namesakes
    k, h = F.col("c_custkey"), F.translate(F.md5(F.col("c_custkey").cast("string").cast("binary")), "0123456789", "ghijklmnop")
    first, last = F.substring(h, 1, 6), F.substring(h, 7, 8)
    name = F.when(k % 10 == 7, F.lit("nomen nescio")).when(k % 50 == 8, F.lit("nomen nescoi")).otherwise(F.concat(first, F.lit(" "), last))
    slip = (F.when(k % 3 == 0, F.concat(F.substring(first, 1, 3), F.substring(first, 5, 2), F.lit(" "), last))
            .when(k % 3 == 1, F.concat(first, F.lit(" z"), F.substring(last, 2, 7)))
            .otherwise(F.concat(F.substring(h, 2, 1), F.substring(h, 1, 1), F.substring(h, 3, 4), F.lit(" "), last)))
    people = F.array_compact(F.array(
        F.struct(k.alias("key"), name.alias("name")),
        F.when(k % 10 == 3, F.struct((k + 1_000_000_000).alias("key"), slip.alias("name"))),
        F.when(k % 10 == 4, F.struct((k + 2_000_000_000).alias("key"), F.upper(F.concat(F.lit(" "), first, F.lit("  "), last)).alias("name")))))
    return namesakes(table(spark, sf_dir, "customer").select(F.inline(people)), "key", "name")


def _dim_versions(spark, sf_dir):
    v = with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS)
    return marts.enrich(v, customer_dim(spark, sf_dir), "o_custkey")


@query
def dim_versioned(spark, sf_dir):
    return _dim_versions(spark, sf_dir).select(
        "version_sk", "o_custkey", "valid_from", "valid_to", "is_current", *STATE_COLUMNS,
        "row_hash", "c_name", "c_mktsegment", "n_name", "r_name")


@query
def obt(spark, sf_dir):
    v = with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS)
    return marts.obt(order_facts(spark, sf_dir), v, "o_custkey", "ship_date",
                     dims=[(customer_dim(spark, sf_dir), "o_custkey")], how="left",
                     horizon=FACT_HORIZON).select(
        "l_orderkey", "l_linenumber", "ship_date", "o_custkey", "version_sk",
        "o_orderstatus", "price", "c_name", "c_mktsegment", "n_name", "r_name")


@query
def incremental_changes(spark, sf_dir):
    v = with_keys(order_history(spark, sf_dir), "o_custkey", STATE_COLUMNS)
    return marts.changes_between(v, "o_custkey", CHANGE_CURRENT, CHANGE_INCOMING)


# Fixed value: the day the incremental snapshot is loaded (the base history holds
# the orders up to the day before the change comparison's current date + 1).
LOAD_DATE = dt.date(2001, 7, 1)


@query
def scd2_incremental(spark, sf_dir):
    """History of orders up to CHANGE_CURRENT with the customers' exits (some of which lie
    after the load), merged with the customer states alive on CHANGE_INCOMING (taken from
    the full history) as a snapshot loaded on LOAD_DATE. Both sides come from ``scd2``, so
    the snapshot is key-unique and no version starts after the load."""
    from strata.operators.history import apply_snapshot, scd2
    log = order_log(spark, sf_dir)
    base = with_keys(scd2(log.filter(F.col("event_date") <= F.lit(CHANGE_CURRENT)),
                          "o_custkey", "event_date", "o_orderkey", STATE_COLUMNS,
                          exits=customer_exits(spark, sf_dir)),
                     "o_custkey", STATE_COLUMNS)
    snapshot = as_of(order_history(spark, sf_dir), F.lit(CHANGE_INCOMING))
    return apply_snapshot(base, snapshot, "o_custkey", STATE_COLUMNS, LOAD_DATE, gate=False)


@query
def coalesced_history(spark, sf_dir):
    """The history of the order status alone, touching versions of one status merged."""
    from strata.operators.history import scd2
    from strata.operators.timeline import coalesce_versions
    versions = scd2(order_log(spark, sf_dir), "o_custkey", "event_date", "o_orderkey", ("o_orderstatus",),
                    exits=customer_exits(spark, sf_dir))
    keyed = with_keys(versions, "o_custkey", ("o_orderstatus",)).drop("version_sk")
    return coalesce_versions(keyed, "o_custkey")


@query
def reloaded_history(spark, sf_dir):
    """``scd2_incremental`` by way of a wrong load: the same day first gets the snapshot with
    another status for key % 3 = 0 and with keys that don't exist (key + 10000000 for
    key % 7 = 0), then the right one, which reopens what the wrong one closed."""
    from strata.operators.history import apply_snapshot, scd2
    log = order_log(spark, sf_dir)
    base = with_keys(scd2(log.filter(F.col("event_date") <= F.lit(CHANGE_CURRENT)), "o_custkey", "event_date",
                          "o_orderkey", STATE_COLUMNS, exits=customer_exits(spark, sf_dir)), "o_custkey", STATE_COLUMNS)
    right = as_of(order_history(spark, sf_dir), F.lit(CHANGE_INCOMING)).select("o_custkey", *STATE_COLUMNS)
    k = F.col("o_custkey")
    wrong = right.withColumn("o_orderstatus", F.when(k % 3 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    wrong = wrong.unionByName(right.filter(k % 7 == 0).withColumn("o_custkey", k + 10_000_000))
    first = apply_snapshot(base, wrong, "o_custkey", STATE_COLUMNS, LOAD_DATE, gate=False, reopen=True)
    return apply_snapshot(first, right, "o_custkey", STATE_COLUMNS, LOAD_DATE, gate=False, reopen=True)


@query
def late_events_spliced(spark, sf_dir):
    """Orders with key % 50 = 7 arrive after the history of all others was stored, and are
    spliced into it; the exits of customers are known from the start."""
    from strata.operators import timeline
    from strata.operators.history import scd2
    from strata.session import shared_dir
    log, exits = order_log(spark, sf_dir), customer_exits(spark, sf_dir)
    late = F.col("o_orderkey") % 50 == 7
    on_time = scd2(log.filter(~late), "o_custkey", "event_date", "o_orderkey", STATE_COLUMNS, exits=exits)
    path = timeline.store_history(on_time, shared_dir(spark, "history"))
    stored = timeline.read_history(spark, path, "o_custkey")
    staged = timeline.splice_events(spark, path, log.filter(late), "o_custkey", "event_date", "o_orderkey", STATE_COLUMNS,
                                    exits=timeline.unplaced_exits(stored, exits, "o_custkey"))
    timeline.finish_splice(spark, path, staged)
    return timeline.read_history(spark, path, "o_custkey")


@query
def bitemporal_asof(spark, sf_dir):
    """Every line item with the state of its customer on its ship day, as known 30 days later by
    two loads of ``orders``: one with the orders up to CHANGE_CURRENT, one with all of them."""
    from strata.operators import timeline
    from strata.operators.history import scd2
    log = order_log(spark, sf_dir)

    def load(events, day):
        versions = scd2(events, "o_custkey", "event_date", "o_orderkey", ("o_orderstatus",))
        return with_keys(versions, "o_custkey", ("o_orderstatus",)).withColumn("load_day", F.lit(day))

    loads = load(log.filter(F.col("event_date") <= F.lit(CHANGE_CURRENT)), CHANGE_CURRENT).unionByName(load(log, LOAD_DATE))
    known = timeline.bitemporal(loads, "o_custkey", ("o_orderstatus",)).drop("row_hash")
    facts = order_facts(spark, sf_dir).withColumn("known_day", F.date_add("ship_date", 30))
    met = timeline.known_asof(facts, known, "o_custkey", "ship_date", "known_day", how="left")
    return met.select("l_orderkey", "l_linenumber", "o_custkey", "ship_date", "known_day", "o_orderstatus")


# Fixed value: the life cycle that the users of ``events`` are held to.
USER_LIFE = LifeCycle(starts=frozenset({"signup"}), ends=frozenset({"error"}), follows={
    "signup": frozenset({"view", "click", "error"}), "view": frozenset({"view", "click", "purchase", "error"}),
    "click": frozenset({"view", "click", "purchase", "error"}), "purchase": frozenset({"view", "click", "error"}),
    "error": frozenset({"signup"})})


def _user_log(spark, sf_dir):
    """``events`` with planted breaks: no kind (id % 101 = 0), an unknown one (% 103 = 0), no day
    (% 107 = 0), no user (% 109 = 0)."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(i % 109 != 0, F.col("user_id")).alias("user_id"),
        F.when(i % 107 != 0, F.col("ts").cast("date")).alias("event_day"),
        F.when(i % 101 == 0, None).when(i % 103 == 0, "transfer").otherwise(F.col("event_type")).alias("event_type"))


@query
def lifecycle_violations(spark, sf_dir):
    return lifecycle.lifecycle_violations(_user_log(spark, sf_dir), USER_LIFE, "user_id", "event_day", "event_id", "event_type")


@query
def lifecycle_counts(spark, sf_dir):
    return lifecycle.lifecycle_counts(lifecycle_violations(spark, sf_dir))


@query
def scd2_reject_counts(spark, sf_dir):
    """Orders that can open no version: no day (key % 97 = 0) or no customer (key % 89 = 0)."""
    from strata.operators.history import scd2_rejects
    k = F.col("o_orderkey")
    log = order_log(spark, sf_dir).withColumn("event_date", F.when(k % 97 != 0, F.col("event_date"))).withColumn(
        "o_custkey", F.when(k % 89 != 0, F.col("o_custkey")))
    rejects = scd2_rejects(log, "o_custkey", "event_date", "o_orderkey", STATE_COLUMNS)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_events"), F.min("o_orderkey").alias("first_order"))


@query
def source_changes(spark, sf_dir):
    """Two sources compared by row hash: ``customer``, and a second delivery of it without
    key % 7 = 0, with another segment where key % 11 = 0, and with new keys (key + 10000000)
    where key % 13 = 0."""
    k = F.col("c_custkey")
    now = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    then = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(
        k % 11 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    fresh = then.filter(k % 13 == 0).withColumn("c_custkey", k + 10_000_000)
    cols = ["c_name", "c_mktsegment"]
    return marts.changes(now.withColumn("row_hash", md5_of(cols)),
                         then.filter(k % 7 != 0).unionByName(fresh).withColumn("row_hash", md5_of(cols)),
                         "c_custkey")


def _calendar(spark, sf_dir, lo, hi):
    return calendar.shape_calendar(holiday_feed(spark, sf_dir), lo, hi)


@query
def shape_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir, WINDOW_LO, WINDOW_HI)


@query
def dim_date(spark, sf_dir):
    return calendar.dim_date(spark, DIM_LO, DIM_HI, _calendar(spark, sf_dir, DIM_LO, DIM_HI),
                             DIM_COUNTRY)


@query
def date_window(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return o.filter(F.col("order_date").between(F.lit(WINDOW_LO), F.lit(WINDOW_HI)))


# --------------------------------------------------------------------------- cleaning

def _date_rules():
    """Gate rules of a landed day column: present but unparseable, and absent."""
    parsed = parse_date("date_text")
    return {"bad_date": F.col("date_text").isNotNull() & parsed.isNull(),
            "null_date": F.col("date_text").isNull()}


@query
def parse_dates(spark, sf_dir):
    o = orders_text(spark, sf_dir)
    return o.select("o_orderkey", "date_text", parse_date("date_text").alias("order_date"))


@query
def quarantine_split(spark, sf_dir):
    """Landed orders with more planted defects, so that every rule fires, alone and with
    others: no day where key % 89 = 2, a negative price where key % 83 = 5."""
    k = F.col("o_orderkey")
    o = (orders_text(spark, sf_dir)
         .withColumn("date_text", F.when(k % 89 != 2, F.col("date_text")))
         .withColumn("price", F.when(k % 83 == 5, -F.col("price")).otherwise(F.col("price"))))
    rules = {**_date_rules(), "nonpositive_price": F.col("price") <= 0}
    good, bad = gates.split_quarantine(o, rules)
    return (good.select("o_orderkey", F.lit(False).alias("quarantined"),
                        F.lit(None).cast("string").alias("violations"))
            .unionByName(bad.select("o_orderkey", F.lit(True).alias("quarantined"),
                                    F.array_join("_violations", ",").alias("violations"))))


@query
def safe_int_cast(spark, sf_dir):
    from strata.functions import safe_int
    p = table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = (F.when(k % 3 == 0, F.concat(size, F.lit(".0")))
            .when(k % 11 == 0, F.concat(F.lit("x"), size)).otherwise(size))
    return p.select("p_partkey", text.alias("size_text")).withColumn(
        "size_int", safe_int("size_text"))


@query
def text_to_bool(spark, sf_dir):
    from strata.functions import text_to_bool as to_bool
    o = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    text = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
            .when(st == "F", F.lit("TRUE")).when(st == "O", F.lit(" true "))
            .otherwise(F.lit("no")))
    return o.select("o_orderkey", text.alias("flag_text")).withColumn(
        "flag", to_bool("flag_text"))


@query
def blank_to_null(spark, sf_dir):
    from strata.functions import blank_to_null as b2n
    c = customer_text(spark, sf_dir)
    return c.select("c_custkey", "segment_text", b2n("segment_text").alias("c_mktsegment"))


@query
def trim_strings(spark, sf_dir):
    c = customer_text(spark, sf_dir).select("c_custkey", "name_text", "segment_text")
    return cleaning.trim_strings(c)


@query
def upper_normalise(spark, sf_dir):
    from strata.functions import upper_text
    e = events_text(spark, sf_dir)
    return e.select("event_id", "type_text", upper_text("type_text").alias("event_type"))


@query
def untrimmed_profile(spark, sf_dir):
    c = customer_text(spark, sf_dir).select("c_custkey", "name_text", "segment_text")
    return gates.untrimmed_counts(c)


@query
def clean_events(spark, sf_dir):
    e = events_text(spark, sf_dir)
    return cleaning.clean(e, dates={"date_text": "event_date"}, ints=["amount_text"],
                          upper=["type_text"], blanks=["note_text"],
                          rename={"type_text": "event_type", "amount_text": "amount",
                                  "note_text": "note"})


@query
def clean_roster(spark, sf_dir):
    c = customer_text(spark, sf_dir)
    out = cleaning.clean(c, ints=["balance_text"], bools=["active_text"],
                         blanks=["segment_text"],
                         rename={"name_text": "c_name", "segment_text": "c_mktsegment",
                                 "balance_text": "balance", "active_text": "is_active"})
    return out


@query
def clean_reference(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    padded = n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        "n_nationkey", F.concat(F.lit(" "), "n_name", F.lit("  ")).alias("n_name"),
        F.concat(F.lit("  "), "r_name").alias("r_name"))
    return cleaning.trim_strings(padded)


# --------------------------------------------------------------------------- gates
# The event vocabulary used by the gates below.
EXIT_TYPES = ("error",)
ALLOWED_TYPES = ("view", "click", "purchase")
START_TYPE = "signup"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")


@query
def state_events(spark, sf_dir):
    return _events(spark, sf_dir).filter(not_in_domain("event_type", EXIT_TYPES)).select(
        "event_id", "user_id", "event_type")


@query
def exit_events(spark, sf_dir):
    from strata.functions import in_domain
    return _events(spark, sf_dir).filter(in_domain("event_type", EXIT_TYPES)).select(
        "event_id", "user_id", "event_type")


@query
def unknown_domain(spark, sf_dir):
    return gates.unknown_values(_events(spark, sf_dir), "event_type", ALLOWED_TYPES)


@query
def duplicate_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return gates.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def _start_planted(spark, sf_dir):
    """Events relabelled so a start rule applies: each user's first event becomes
    'signup' (except user_id % 10 = 1), later 'signup's become 'view' (except
    user_id % 10 = 0). The first event is found by an aggregate, not a window."""
    e = _events(spark, sf_dir)
    firsts = (e.groupBy("user_id")
              .agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))
              .select("event_id", F.lit(True).alias("_first")))
    u = F.col("user_id")
    first = F.coalesce(F.col("_first"), F.lit(False))
    typ = (F.when(first & (u % 10 != 1), F.lit(START_TYPE))
           .when(~first & (F.col("event_type") == START_TYPE) & (u % 10 != 0), F.lit("view"))
           .otherwise(F.col("event_type")))
    return e.join(firsts, "event_id", "left").select("event_id", "user_id", "ts",
                                                     typ.alias("event_type"))


@query
def exactly_one_start(spark, sf_dir):
    return gates.start_violations(_start_planted(spark, sf_dir), "user_id", "event_type",
                                  ["ts", "event_id"], START_TYPE)


@query
def gate_summary(spark, sf_dir):
    """Landed orders with planted keys: NULL where key % 101 = 0, one of seven shared keys
    where key % 53 = 0; and no day where key % 89 = 2."""
    k = F.col("o_orderkey")
    o = (orders_text(spark, sf_dir)
         .withColumn("date_text", F.when(k % 89 != 2, F.col("date_text")))
         .withColumn("gate_key", F.when(k % 101 == 0, F.lit(None))
                     .when(k % 53 == 0, -(k % 7) - 1).otherwise(k)))
    return gates.profile(o, _date_rules(), key="gate_key")


@query
def category_distribution(spark, sf_dir):
    return (_events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"))
            .orderBy("event_type"))


@query
def preview_top_n(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("price")
                    ).orderBy("o_orderkey").limit(10)


@query
def chronological_log(spark, sf_dir):
    """The whole event log in order of day, then entity, then event, with each event's position."""
    log = order_log(spark, sf_dir).select("event_date", "o_custkey", "o_orderkey")
    return with_position(log, ["event_date", "o_custkey", "o_orderkey"]).orderBy("position")


# --------------------------------------------------------------------------- nested
# Wanted URL parameters -> output columns, nested paths -> columns.
PARAM_COLUMNS = {"page": "param_page", "ref": "param_ref", "utm_source": "param_utm_source"}
CUSTOMER_PATHS = {"profile.name": "name", "profile.segment": "segment",
                  "address.nation": "nation_name", "address.region.name": "region_name"}


@query
def flatten_struct(spark, sf_dir):
    return nested.flatten(customer_nested(spark, sf_dir), CUSTOMER_PATHS, keep=["c_custkey"])


@query
def flag_and_null(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nested.flag_null(d, "text", no_digit("text"), "text_invalid")


@query
def pivot_keyed_array(spark, sf_dir):
    return nested.lookup(page_params(spark, sf_dir), "params", PARAM_COLUMNS).select(
        "page_id", *PARAM_COLUMNS.values())


# Conversation roles -> output columns.
ROLE_COLUMNS = {"system": "first_system", "user": "first_user", "assistant": "first_assistant"}


@query
def pivot_pairs(spark, sf_dir):
    """Conversation turns as (role, text) pairs -> first text of each role per
    conversation, without collecting a conversation into an array."""
    c = table(spark, sf_dir, "conversations")
    return nested.pivot_pairs(c, "conv_id", "role", "text", "turn", ROLE_COLUMNS)


@query
def explode_pairs(spark, sf_dir):
    return nested.explode_pairs(page_params(spark, sf_dir), "params", ["page_id"])


@query
def first_array_element(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return nested.first_element(p, "words", "first_word").select("p_partkey", "first_word")


@query
def row_count_preserved(spark, sf_dir):
    """Keys whose rows multiply when ``enrich`` meets attributes that failed their uniqueness
    gate: a second attribute row is planted where key % 50 = 0, a third where key % 150 = 0."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    copies = F.sequence(F.lit(1), F.when(k % 150 == 0, 3).when(k % 50 == 0, 2).otherwise(1))
    attrs = c.select("c_custkey", "c_mktsegment", F.explode(copies).alias("copy"))
    return gates.row_count_check(c.select("c_custkey"),
                                 marts.enrich(c.select("c_custkey", "c_name"), attrs, "c_custkey"),
                                 "c_custkey")


@query
def nested_profile(spark, sf_dir):
    return nested.nested_profile(customer_nested(spark, sf_dir),
                                 null_paths=["address", "address.region.name", "profile.name"])


@query
def sql_nested_probe(spark, sf_dir):
    """The SQL surface over a temp view: struct field access, ``WHERE x = ...``,
    ``WHERE x IN (...)`` and ``size()``, one probe per row."""
    view = "strata_pages_params"
    page_params(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT 'empty_params' AS probe, count(*) AS n FROM {view} WHERE size(params) = 0
        UNION ALL
        SELECT 'first_key_known', count(*) FROM {view}
        WHERE get(params, 0).key IN ('page', 'utm_source')
        UNION ALL
        SELECT 'second_page', count(*) FROM {view} WHERE get(params, 0).value = '2'
        UNION ALL
        SELECT 'multi_params', count(*) FROM {view} WHERE size(params) >= 2""")


# --------------------------------------------------------------------------- sources
# The input table names and one required table that never lands there, so
# the check has something to report.
INPUT_TABLES = ("region nation customer supplier part orders lineitem events documents "
                "embeddings pages benchmark labels conversations").split()
ABSENT_REQUIRED = "employees"


@query
def audit_columns(spark, sf_dir):
    from strata.sources.files import with_audit
    return with_audit(table(spark, sf_dir, "orders")).select(
        "o_orderkey", "_source_file", F.col("_ingested_at").isNotNull().alias("has_ingested_at"))


def _if_there(spark, sf_dir, name):
    try:
        return table(spark, sf_dir, name)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@query
def table_counts(spark, sf_dir):
    from strata.sources.files import table_counts as counts
    return counts({t: _if_there(spark, sf_dir, t) for t in [*INPUT_TABLES, ABSENT_REQUIRED]})


@query
def multi_source_union(spark, sf_dir):
    """Events landed as one folder per source, read back as one scan. Source names hold
    spaces, slashes and colons, and some events have none."""
    from strata.session import shared_dir
    from strata.sources.files import union_sources, write_table
    path = shared_dir(spark, "multi-source")
    i, t = F.col("event_id") % 5, F.col("event_type")
    source = (F.when(i == 0, F.concat(t, F.lit(" up"))).when(i == 1, F.concat(t, F.lit("/x:y=%")))
              .when(i == 2, F.lit(None)).otherwise(t))
    write_table(_events(spark, sf_dir).select("event_id", "user_id", source.alias("source")), path,
                partition_by=["source"])
    return union_sources(spark, path, source_column="source").select(
        "event_id", "user_id", F.col("_source").alias("source"))


@query
def csv_roundtrip(spark, sf_dir):
    """Events landed as CSV with broken lines: key % 97 = 3 ends after the first field,
    key % 89 = 4 has one field too many. Every line comes back, the broken ones with their
    raw text."""
    from strata.session import shared_dir
    from strata.sources.files import CORRUPT, all_string_schema, scan_csv, write_table
    cols = ["event_id", "user_id", "event_type"]
    path = shared_dir(spark, "csv")
    k = F.col("event_id")
    line = (F.when(k % 97 == 3, k.cast("string"))
            .when(k % 89 == 4, F.concat_ws(",", *cols, F.lit("extra")))
            .otherwise(F.concat_ws(",", *cols)))
    # one column whose name is the header; a separator that no line holds keeps lines as they are
    write_table(_events(spark, sf_dir).select(line.alias(",".join(cols))), path, fmt="csv",
                header="true", sep="\x01")
    return scan_csv(spark, path, all_string_schema(cols)).select(
        *cols, F.col(CORRUPT).alias("broken_line"))


# The wanted columns, and the header of each landed layout (event_id % 3): as wanted, in
# another order and case, and with one column missing and one more.
EVENT_COLUMNS = ("event_id", "user_id", "event_type")
EVENT_LAYOUTS = {0: ("event_id", "user_id", "event_type"), 1: ("EVENT_TYPE", "event_id", "user_id"),
                 2: ("user_id", "event_id", "note")}


def _landed_layouts(spark, sf_dir):
    """Events landed as CSV under three headers, with broken lines as in ``csv_roundtrip``."""
    from strata.session import shared_dir
    from strata.sources.files import write_table
    from strata.sources.headers import scan_csv_by_name
    path = shared_dir(spark, "csv-layouts")
    k = F.col("event_id")
    events = _events(spark, sf_dir).withColumn("note", F.concat(F.lit("n"), k.cast("string")))
    for i, header in EVENT_LAYOUTS.items():
        line = (F.when(k % 97 == 3, F.col(header[0]).cast("string"))
                .when(k % 89 == 4, F.concat_ws(",", *header, F.lit("more")))
                .otherwise(F.concat_ws(",", *header)))
        write_table(events.filter(k % 3 == i).select(line.alias(",".join(header))), f"{path}/{i}", fmt="csv",
                    header="true", sep="\x01")
    return scan_csv_by_name(spark, path, EVENT_COLUMNS)


@query
def csv_by_header(spark, sf_dir):
    """Every line under every header, bound by name."""
    from strata.sources.files import CORRUPT
    from strata.sources.headers import HEADER
    return _landed_layouts(spark, sf_dir).select(*EVENT_COLUMNS, F.col(CORRUPT).alias("broken_line"),
                                                 F.array_join(HEADER, ",").alias("header"))


@query
def csv_header_report(spark, sf_dir):
    """Missing and extra columns of each header, with its lines and its broken lines."""
    from strata.sources.headers import header_report
    return header_report(_landed_layouts(spark, sf_dir), EVENT_COLUMNS)


# What the landed orders are expected to be.
ORDER_JSON_SCHEMA = ("id bigint, status string, price decimal(18,2), detail struct<priority: string, customer: bigint>, "
                     "tags array<struct<key: string, value: string>>")


def _landed_orders(spark, sf_dir):
    """Orders landed as JSON lines that drift from their schema: an unknown field (key % 7 = 0), price as
    text (% 11), an unknown nested field (% 13) where the struct isn't null (% 19), tag values as numbers
    (% 17), truncated lines (% 97 = 3)."""
    from strata.session import shared_dir
    from strata.sources.drift import scan_variant
    from strata.sources.files import write_table
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price, key = F.col("o_totalprice").cast("decimal(18,2)").cast("string"), k.cast("string")

    def text(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    detail = F.concat(F.lit('{"priority":'), text(F.col("o_orderpriority")), F.lit(',"customer":'),
                      F.col("o_custkey").cast("string"), F.when(k % 13 == 0, F.lit(',"weight":1.5')).otherwise(""), F.lit("}"))
    value = F.when(k % 17 == 0, key).otherwise(text(key))
    whole = F.concat(F.lit('{"id":'), key, F.lit(',"status":'), text(F.col("o_orderstatus")), F.lit(',"price":'),
                     F.when(k % 11 == 0, text(price)).otherwise(price),
                     F.when(k % 7 == 0, F.lit(',"channel":"web"')).otherwise(""),
                     F.lit(',"detail":'), F.when(k % 19 == 0, "null").otherwise(detail),
                     F.lit(',"tags":[{"key":"order","value":'), value, F.lit('},{"key":"again","value":'), value, F.lit("}]}"))
    path = shared_dir(spark, "variant")
    write_table(o.select(F.when(k % 97 == 3, F.concat(F.lit('{"id":'), key)).otherwise(whole).alias("value")), path, fmt="text")
    return scan_variant(spark, path)


@query
def variant_fields(spark, sf_dir):
    """Typed fields of the landed orders; a truncated line keeps its raw text."""
    from strata.sources.drift import BROKEN, read_fields
    back = read_fields(_landed_orders(spark, sf_dir), ORDER_JSON_SCHEMA)
    return back.select("id", "status", "price", F.col("detail.priority").alias("priority"),
                       F.col("detail.customer").alias("customer"),
                       F.get("tags", F.lit(0))["value"].alias("tag"), F.col(BROKEN).alias("broken_line"))


@query
def json_drift_report(spark, sf_dir):
    """Unknown, retyped and broken parts of the landed orders, counted."""
    from strata.sources.drift import drift_report
    return drift_report(_landed_orders(spark, sf_dir), ORDER_JSON_SCHEMA)


# --------------------------------------------------------------------------- sketches
PROFILED = ("o_custkey", "o_orderstatus", "price", "order_date")


def _profile_runs(spark, sf_dir):
    """Orders as loads, one a year; no price where key % 10 = 0, and the loads from 1999 on have another
    scale of prices and no status where key % 4 = 0."""
    k, year = F.col("o_orderkey"), F.year("o_orderdate")
    late = year >= 1999
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(~late | (k % 4 != 0), F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 10 != 0, F.when(late, price * 3).otherwise(price)).cast("double").alias("price"),
        F.col("o_orderdate").cast("date").alias("order_date"), year.alias("load_year"))


def _stored_profiles(spark, sf_dir):
    from strata.operators.sketches import column_profiles
    from strata.session import materialize
    return materialize(column_profiles(_profile_runs(spark, sf_dir), PROFILED, run="load_year"), how="table")


@query
def merged_profiles(spark, sf_dir):
    """Profiles of all loads merged, beside the exact figures: is each estimate within its stated error?"""
    from strata.operators.sketches import DECILES, DISTINCT_ERROR, RANK_ERROR, estimates, merge_profiles
    got = estimates(merge_profiles(_stored_profiles(spark, sf_dir)))
    runs = _profile_runs(spark, sf_dir)
    numbers = {c: F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double") if c == "order_date"
               else F.col(c).cast("double") for c in PROFILED if c != "o_orderstatus"}
    long = runs.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                 numbers.get(c, F.lit(None).cast("double")).alias("number")) for c in PROFILED])))
    per_value = long.filter("value IS NOT NULL").groupBy("column", "value", "number").agg(F.count("*").alias("n"))
    at = got.select("column", "n_distinct", "quantiles")
    exact = (per_value.join(at, "column").groupBy("column")
             .agg(F.count("*").alias("distinct"), F.sum("n").alias("held"), F.first("n_distinct").alias("n_distinct"),
                  F.first("quantiles").isNotNull().alias("ordered"),
                  *[F.sum(F.when(F.col("number") <= F.get("quantiles", F.lit(i)), F.col("n")).otherwise(0)).alias(f"up{i}")
                    for i in range(len(DECILES))],
                  *[F.sum(F.when(F.col("number") < F.get("quantiles", F.lit(i)), F.col("n")).otherwise(0)).alias(f"below{i}")
                    for i in range(len(DECILES))]))
    close = F.lit(True)
    for i, r in enumerate(DECILES):                         # the rank wanted lies within the value's own ranks
        close = close & (F.col(f"up{i}") / F.col("held") >= r - RANK_ERROR) & (F.col(f"below{i}") / F.col("held") <= r + RANK_ERROR)
    checked = exact.select("column", (F.abs(F.col("n_distinct") - F.col("distinct")) <= F.col("distinct") * DISTINCT_ERROR + 1)
                           .alias("distinct_close"), (~F.col("ordered") | close).alias("quantiles_close"))
    return got.join(checked, "column").select("column", "n_rows", "n_null", "distinct_close", "quantiles_close")


@query
def load_drift(spark, sf_dir):
    """Columns that changed between the loads before 1999 and those after, from stored profiles alone."""
    from strata.operators.sketches import merge_profiles, profile_drift
    runs = _stored_profiles(spark, sf_dir)
    found = profile_drift(merge_profiles(runs.filter("load_year < 1999")), merge_profiles(runs.filter("load_year >= 1999")))
    return found.select("column", (F.abs("null_shift") > 0.1).alias("nulls_changed"),
                        F.coalesce(F.col("rank_shift") > 0.15, F.lit(False)).alias("values_changed"))


# --------------------------------------------------------------------------- working days
CALENDAR = (dt.date(1995, 1, 1), dt.date(2002, 12, 31))


def _work_calendar(spark, sf_dir):
    """Working days of each order status as a country, whose holidays are the days of each month's
    dearest order (ties: the largest key)."""
    from strata.operators.workdays import working_calendar
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    holidays = (o.groupBy(F.col("o_orderstatus").alias("country"), F.trunc(day, "month").alias("month"))
                .agg(F.max_by(day, F.struct("o_totalprice", "o_orderkey")).alias("date")))
    return working_calendar(o.select(F.col("o_orderstatus").alias("country")), holidays, *CALENDAR)


@query
def ship_working_days(spark, sf_dir):
    """Working days from order to shipping of every line item, and the fifth working day after the order."""
    from strata.operators.workdays import add_working_days, working_days_between
    cal = _work_calendar(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("country"),
                                              F.col("o_orderdate").cast("date").alias("order_date"))
    due = add_working_days(o, cal, "country", "order_date", 5)
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))
    return working_days_between(li.join(due, "l_orderkey"), cal, "country", "order_date", "ship_date")


SUPPLIER_JSON_SCHEMA = (
    "s_suppkey bigint, s_name string, "
    "nation struct<key: int, name: string, region: struct<key: int>>, "
    "tags array<struct<key: string, value: string>>")


@query
def json_nested_roundtrip(spark, sf_dir):
    from pyspark.sql.types import StructType
    from strata.session import shared_dir
    from strata.sources.files import scan_json, write_table
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    rec = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select(
        "s_suppkey", "s_name",
        F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
                 F.struct(F.col("n_regionkey").alias("key")).alias("region")).alias("nation"),
        F.array(F.struct(F.lit("nation").alias("key"), F.col("n_name").alias("value")),
                F.struct(F.lit("name").alias("key"), F.col("s_name").alias("value"))
                ).alias("tags"))
    path = shared_dir(spark, "json")
    write_table(rec, path, fmt="json")
    back = scan_json(spark, path, StructType.fromDDL(SUPPLIER_JSON_SCHEMA))
    flat = nested.flatten(back, {"nation.key": "nation_key", "nation.name": "nation_name",
                                 "nation.region.key": "region_key"},
                          keep=["s_suppkey", "s_name", "tags"])
    return nested.lookup(flat, "tags", {"nation": "tag_nation"})


@query
def idempotent_overwrite(spark, sf_dir):
    from strata.session import shared_dir
    from strata.sources.files import read_table, write_table
    path = shared_dir(spark, "overwrite")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(orders, path)
    write_table(orders, path)        # a retry must leave exactly one copy
    return read_table(spark, path)
