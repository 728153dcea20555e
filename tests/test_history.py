import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.history import SENTINEL, as_of, next_event, scd2

D = dt.date
EXITS = ("RESIGNATION", "TERMINATION")
SCHEMA = "eid string, emp string, kind string, day date, dept string, salary int"


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _versions(df, **kw):
    out = scd2(df, key="emp", date="day", order="eid", state=["dept", "salary"],
               is_exit=F.col("kind").isin(*EXITS), **kw)
    return sorted((r["emp"], r["valid_from"], r["valid_to"], r["is_current"], r["dept"])
                  for r in out.collect())


def test_each_state_event_opens_a_version(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "PROMOTION", D(2026, 3, 1), "D1", 12),
        ("E3", "A", "TRANSFER", D(2026, 5, 10), "D2", 12),
        ("E4", "B", "HIRE", D(2026, 2, 1), "D2", 9),
    ])
    assert _versions(df) == [
        ("A", D(2026, 1, 1), D(2026, 2, 28), False, "D1"),
        ("A", D(2026, 3, 1), D(2026, 5, 9), False, "D1"),
        ("A", D(2026, 5, 10), SENTINEL, True, "D2"),
        ("B", D(2026, 2, 1), SENTINEL, True, "D2"),
    ]


def test_exit_closes_last_version_on_exit_day(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "TRANSFER", D(2026, 2, 1), "D2", 10),
        ("E3", "A", "RESIGNATION", D(2026, 4, 15), "D2", 10),
    ])
    assert _versions(df) == [
        ("A", D(2026, 1, 1), D(2026, 1, 31), False, "D1"),
        ("A", D(2026, 2, 1), D(2026, 4, 15), False, "D2"),
    ]


def test_same_day_last_keeps_highest_order(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "TRANSFER", D(2026, 1, 1), "D2", 10),
        ("E3", "A", "PROMOTION", D(2026, 2, 1), "D2", 11),
    ])
    assert _versions(df, same_day="last") == [
        ("A", D(2026, 1, 1), D(2026, 1, 31), False, "D2"),
        ("A", D(2026, 2, 1), SENTINEL, True, "D2"),
    ]


def test_same_day_fail_reports_inverted_interval(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "TRANSFER", D(2026, 1, 1), "D2", 10),
    ])
    rows = _versions(df, same_day="fail")
    assert ("A", D(2026, 1, 1), D(2025, 12, 31), False, "D1") in rows
    assert ("A", D(2026, 1, 1), SENTINEL, True, "D2") in rows
    assert len(rows) == 2


def test_two_exits_do_not_duplicate_versions(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "RESIGNATION", D(2026, 3, 1), "D1", 10),
        ("E3", "A", "TERMINATION", D(2026, 3, 5), "D1", 10),
    ])
    rows = _versions(df)
    assert len(rows) == 1
    assert rows[0][2] == D(2026, 3, 5)   # the last exit closes it


def test_exit_before_later_state_is_inverted_in_strict_mode(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "RESIGNATION", D(2026, 2, 1), "D1", 10),
        ("E3", "A", "HIRE", D(2026, 4, 1), "D2", 10),
    ])
    strict = _versions(df)
    assert ("A", D(2026, 4, 1), D(2026, 2, 1), False, "D2") in strict   # caught by the gate
    rehired = _versions(df, rehire=True)
    assert rehired == [
        ("A", D(2026, 1, 1), D(2026, 2, 1), False, "D1"),
        ("A", D(2026, 4, 1), SENTINEL, True, "D2"),
    ]


def test_null_event_type_is_a_state_event_not_an_exit(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", None, D(2026, 2, 1), "D3", 10),
    ])
    assert len(_versions(df)) == 2


def test_extra_exits_frame(spark):
    df = _events(spark, [("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10)])
    exits = spark.createDataFrame([("A", D(2026, 6, 30))], "emp string, day date")
    out = scd2(df, "emp", "day", "eid", ["dept"], exits=exits).collect()
    assert out[0]["valid_to"] == D(2026, 6, 30) and not out[0]["is_current"]


def test_next_event_and_as_of(spark):
    df = _events(spark, [
        ("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10),
        ("E2", "A", "TRANSFER", D(2026, 3, 1), "D2", 10),
    ])
    ne = sorted((r["valid_from"], r["next_from"], r["valid_to"])
                for r in next_event(df, "emp", "day", "eid").collect())
    assert ne == [(D(2026, 1, 1), D(2026, 3, 1), D(2026, 2, 28)),
                  (D(2026, 3, 1), None, SENTINEL)]
    v = scd2(df, "emp", "day", "eid", ["dept"])
    alive = as_of(v, F.lit(D(2026, 2, 15))).collect()
    assert [r["dept"] for r in alive] == ["D1"]


def test_window_is_one_shuffle_on_key(spark):
    df = _events(spark, [("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10)])
    v = scd2(df, "emp", "day", "eid", ["dept"], is_exit=F.col("kind").isin(*EXITS))
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1


def test_bad_same_day_mode(spark):
    df = _events(spark, [("E1", "A", "HIRE", D(2026, 1, 1), "D1", 10)])
    with pytest.raises(ValueError):
        scd2(df, "emp", "day", "eid", ["dept"], same_day="first")


def test_hot_key_is_collapsed_before_the_window(spark):
    """One key with 40,000 events on 20 days: 20 versions, and the rows that reach
    the window for that key are the 20 collapsed days, not the 40,000 events."""
    n, days = 40000, 20
    df = (spark.range(n).select(
        F.col("id").alias("eid"), F.lit("HOT").alias("emp"), F.lit("PROMOTION").alias("kind"),
        F.date_add(F.lit(D(2026, 1, 1)), (F.col("id") % days).cast("int")).alias("day"),
        F.col("id").cast("string").alias("dept"), F.lit(1).alias("salary")))
    v = scd2(df, "emp", "day", "eid", ["dept"], is_exit=F.col("kind").isin(*EXITS))
    rows = v.orderBy("valid_from").collect()
    assert len(rows) == days
    assert rows[0]["dept"] == str(n - days)        # last event of day 0 by order
    assert rows[-1]["is_current"]
    plan = v._jdf.queryExecution().executedPlan().toString()
    window_input = plan.split("Window")[1]
    assert "Aggregate" in window_input              # the window reads collapsed days


def _keyed(spark, rows):
    from strata.operators.keys import with_keys
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, is_current boolean, v string")
    return with_keys(df, "k", ["v"]).drop("version_sk")


def _merged(spark, hist, snap, day):
    from strata.operators.history import apply_snapshot
    out = apply_snapshot(hist, spark.createDataFrame(snap, "k string, v string"), "k", ["v"], day)
    return sorted((r["k"], r["valid_from"], r["valid_to"], r["is_current"], r["v"]) for r in out.collect())


def test_corrected_snapshot_of_the_same_day_replaces(spark):
    day = D(2026, 7, 1)
    hist = _keyed(spark, [("a", D(2026, 1, 1), SENTINEL, True, "x"), ("b", D(2026, 1, 1), SENTINEL, True, "p")])
    first = _merged(spark, hist, [("a", "y"), ("b", "p"), ("n", "1")], day)
    again = _merged(spark, _keyed(spark, first), [("a", "z"), ("b", "p")], day)
    assert again == [("a", D(2026, 1, 1), D(2026, 6, 30), False, "x"), ("a", day, SENTINEL, True, "z"),
                     ("b", D(2026, 1, 1), SENTINEL, True, "p")]     # n never lived a day


def test_future_exit_counts_as_open_and_stays_planned(spark):
    day, out = D(2026, 7, 1), D(2026, 9, 30)
    hist = _keyed(spark, [("a", D(2026, 1, 1), out, False, "x"), ("b", D(2026, 1, 1), out, False, "p"),
                             ("c", D(2026, 1, 1), D(2026, 6, 30), False, "q")])
    assert _merged(spark, hist, [("a", "y"), ("b", "p"), ("c", "q")], day) == [
        ("a", D(2026, 1, 1), D(2026, 6, 30), False, "x"), ("a", day, out, False, "y"),
        ("b", D(2026, 1, 1), out, False, "p"),
        ("c", D(2026, 1, 1), D(2026, 6, 30), False, "q"), ("c", day, SENTINEL, True, "q")]


@pytest.mark.parametrize("snap,day,rule", [
    ([("a", "y"), ("a", "z")], D(2026, 7, 1), "duplicate_keys=1"), ([(None, "y")], D(2026, 7, 1), "null_keys=1"),
    ([("a", "y")], D(2025, 7, 1), "later_versions=1")])
def test_snapshots_that_cannot_be_merged_are_refused(spark, snap, day, rule):
    from strata.operators.gates import QualityError
    with pytest.raises(QualityError, match=rule):
        _merged(spark, _keyed(spark, [("a", D(2026, 1, 1), SENTINEL, True, "x")]), snap, day)


def test_ties_and_undated_events_are_kept_or_reported(spark):
    from strata.operators.history import scd2_rejects
    rows = [("a", 1, D(2026, 1, 1), "x"), ("a", 1, D(2026, 1, 1), "y"), ("a", 1, D(2026, 1, 1), "y"),
            ("a", 2, None, "z"), (None, 3, D(2026, 1, 1), "w"), ("a", 0, D(2026, 1, 1), None)]
    ev = spark.createDataFrame(rows, "k string, o int, d date, v string")
    got = scd2(ev, "k", "d", "o", ["v"], same_day="fail").collect()
    assert sorted((r["o"], r["v"] or "", r["valid_to"] == SENTINEL) for r in got) == [
        (0, "", False), (1, "x", False), (1, "y", False), (1, "y", True)]
    bad = scd2_rejects(ev, "k", "d", "o", ["v"]).collect()
    assert sorted((r["o"], r["reason"]) for r in bad) == [(2, "null_day"), (3, "null_key")]


def test_apply_snapshot_opens_closes_and_keeps(spark):
    from strata.operators.history import apply_snapshot
    from strata.operators.keys import with_keys
    hist = spark.createDataFrame([
        ("a", D(2025, 1, 1), D(2025, 12, 31), False, "x"),
        ("a", D(2026, 1, 1), SENTINEL, True, "y"),
        ("b", D(2026, 1, 1), SENTINEL, True, "p"),
        ("c", D(2026, 1, 1), SENTINEL, True, "q"),
    ], "k string, valid_from date, valid_to date, is_current boolean, v string")
    hist = with_keys(hist, "k", ["v"]).drop("version_sk")
    snap = spark.createDataFrame([("a", "y"), ("b", "p2"), ("d", "n")], "k string, v string")
    out = sorted((r["k"], r["valid_from"], r["valid_to"], r["is_current"], r["v"]) for r in
                 apply_snapshot(hist, snap, "k", ["v"], D(2026, 7, 1)).collect())
    assert out == [
        ("a", D(2025, 1, 1), D(2025, 12, 31), False, "x"),
        ("a", D(2026, 1, 1), SENTINEL, True, "y"),                 # unchanged
        ("b", D(2026, 1, 1), D(2026, 6, 30), False, "p"),          # changed: closed
        ("b", D(2026, 7, 1), SENTINEL, True, "p2"),                # ... and reopened
        ("c", D(2026, 1, 1), D(2026, 6, 30), False, "q"),          # gone
        ("d", D(2026, 7, 1), SENTINEL, True, "n"),                 # new
    ]
