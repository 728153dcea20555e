"""Coalescing, reopened versions, late events, two time axes: against plain Python."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import timeline
from strata.operators.history import SENTINEL, apply_snapshot, scd2
from strata.operators.keys import with_keys

BASE, ONE = dt.date(2020, 11, 1), dt.timedelta(days=1)
EASY = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
VERSIONS = "k string, valid_from date, valid_to date, is_current boolean, v string"


def day(n):
    return BASE + n * ONE


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def keyed(spark, rows):
    return with_keys(spark.createDataFrame(rows, VERSIONS), "k", ["v"]).drop("version_sk")


def merged(rows):
    """Touching versions with one state, merged one after another."""
    out = []
    for k, lo, hi, cur, v in sorted(rows, key=lambda r: (r[0], r[1])):
        if out and out[-1][0] == k and out[-1][4] == v and out[-1][2] + ONE == lo:
            out[-1] = (k, out[-1][1], hi, cur, v)
        else:
            out.append((k, lo, hi, cur, v))
    return sorted(out, key=str)


# ---------------------------------------------------------------- coalescing

@EASY
@given(st.dictionaries(st.sampled_from("ab"), st.lists(st.tuples(st.integers(1, 3), st.integers(0, 1), st.sampled_from(["x", "y", None])),
                                                       max_size=9), max_size=2))
def test_coalesce_matches_brute_force(spark, lives):
    rows = []
    for k, spans in lives.items():
        at = 0
        for length, gap, v in spans:
            rows.append((k, day(at), day(at + length - 1), False, v))
            at += length + gap
    got = rows_of(timeline.coalesce_versions(keyed(spark, rows), "k"), "k", "valid_from", "valid_to", "is_current", "v")
    assert got == merged(rows)


def test_coalesce_leaves_odd_versions_alone(spark):
    rows = [("a", day(0), day(3), False, "x"), ("a", day(4), SENTINEL, True, "x"), ("a", day(4), day(2), False, "x"),
            (None, day(0), day(1), False, "x"), (None, day(2), day(3), False, "x"), ("b", None, day(1), False, "x"),
            ("c", day(0), day(1), False, "x"), ("c", day(0), day(1), False, "x")]
    df = keyed(spark, rows).withColumn("more", F.col("valid_from").cast("string"))
    out = timeline.coalesce_versions(df, "k")
    assert out.columns == df.columns
    want = [r for r in rows[2:]] + [("a", day(0), SENTINEL, True, "x")]
    assert rows_of(out, "k", "valid_from", "valid_to", "is_current", "v") == sorted(want, key=str)
    assert out.filter("k = 'a' and is_current").first()["more"] == str(day(0))
    assert timeline.coalesce_versions(df.limit(0), "k").collect() == []


def test_coalesce_is_one_shuffle(spark):
    plan = timeline.coalesce_versions(keyed(spark, [("a", day(0), day(1), False, "x")]), "k")._jdf.queryExecution().executedPlan().toString()
    # by key and by whether a version can take part: the aggregate reuses the window's partitioning
    assert plan.count("Exchange hashpartitioning") == 1


states = st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["x", "y"]), max_size=4)


@EASY
@given(states, states, states, states)
def test_a_corrected_load_leaves_no_trace(spark, start, yesterday, wrong, right):
    """A wrong load and its correction end in the same history as the right load alone, and no
    two touching versions share a state."""
    load = day(10)
    hist = keyed(spark, [("zz", day(0), day(5), False, "q")] + [(k, day(0), SENTINEL, True, v) for k, v in start.items()])

    def apply(h, snap, d):
        s = spark.createDataFrame(list(snap.items()) or [("never", "x")], "k string, v string").filter("k <> 'never'")
        return apply_snapshot(h, s, "k", ["v"], d, reopen=True)

    hist = apply(hist, yesterday, day(9))
    cols = ("k", "valid_from", "valid_to", "is_current", "v")
    once = rows_of(apply(hist, right, load), *cols)
    assert rows_of(apply(apply(hist, wrong, load), right, load), *cols) == once == merged(once)


def test_reopened_versions_by_case(spark):
    load = day(10)
    hist = keyed(spark, [("a", day(0), day(9), False, "x"), ("a", load, SENTINEL, True, "y"),      # restored
                         ("b", day(0), day(9), False, "x"),                                        # came back
                         ("c", day(0), day(9), False, "x"), ("c", load, day(30), False, "y"),      # a planned end stays
                         ("d", day(0), day(8), False, "x"), ("e", day(0), day(9), False, "x")])    # a gap; another state
    snap = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("e", "z")], "k string, v string")
    assert rows_of(apply_snapshot(hist, snap, "k", ["v"], load, reopen=True), "k", "valid_from", "valid_to", "v") == [
        ("a", day(0), SENTINEL, "x"), ("b", day(0), SENTINEL, "x"), ("c", day(0), day(30), "x"),
        ("d", day(0), day(8), "x"), ("d", load, SENTINEL, "x"), ("e", day(0), day(9), "x"), ("e", load, SENTINEL, "z")]


# ---------------------------------------------------------------- late events

LOG = "eid int, k string, day date, kind string, v int"
log = st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from([0, 1, 40, 70, 400, 401]), st.sampled_from("SSSX"),
                         st.integers(0, 2), st.booleans()), min_size=1, max_size=14)


def history(spark, rows):
    return scd2(spark.createDataFrame(rows, LOG), "k", "day", "eid", ["v"], is_exit=F.col("kind") == "X")


@EASY
@given(log)
def test_splice_equals_a_replay_of_all_events(spark, tmp_path_factory, evs):
    rows = [(i, k, day(d), kind, v) for i, (k, d, kind, v, _) in enumerate(evs)]
    early = [r for r, e in zip(rows, evs) if not e[4]] or rows[:1]
    late = [r for r in rows if r not in early]
    path = str(tmp_path_factory.mktemp("history") / "h")
    timeline.store_history(history(spark, early), path)
    stored = timeline.read_history(spark, path, "k")
    exits = spark.createDataFrame(early, LOG).filter("kind = 'X'").select("k", "day")
    staged = timeline.splice_events(spark, path, spark.createDataFrame(late, LOG), "k", "day", "eid", ["v"], F.col("kind") == "X",
                                    exits=timeline.unplaced_exits(stored, exits, "k"))
    timeline.finish_splice(spark, path, staged)
    cols = ("k", "valid_from", "valid_to", "is_current", "eid", "v")
    want = rows_of(history(spark, rows), *cols)
    assert rows_of(timeline.read_history(spark, path, "k"), *cols) == want
    timeline.finish_splice(spark, path, staged)              # as after a crash: the same again
    assert rows_of(timeline.read_history(spark, path, "k"), *cols) == want


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_untouched_folders_keep_their_files(spark, tmp_path):
    rows = [(i, k, dt.date(2015 + y, 3, 1), "S", y) for i, (k, y) in enumerate((k, y) for k in "abcdef" for y in range(5))]
    path = timeline.store_history(history(spark, rows), str(tmp_path / "h"))
    before = files(path)
    late = spark.createDataFrame([(99, "a", dt.date(2017, 6, 1), "S", 7), (98, None, dt.date(2017, 6, 1), "S", 7),
                                  (97, "b", None, "S", 7)], LOG)
    staged = timeline.splice_events(spark, path, late, "k", "day", "eid", ["v"])
    assert files(path) == before                             # staging changes nothing
    timeline.finish_splice(spark, path, staged)
    after = files(path)
    touched = {f.split("/")[-2] for f in set(before) ^ set(after)}
    assert touched == {"ends_in=2017", "ends_in=2018"}       # one version is cut in two
    assert rows_of(timeline.read_history(spark, path, "k"), "k", "valid_from", "valid_to", "v") == rows_of(
        history(spark, rows + [(99, "a", dt.date(2017, 6, 1), "S", 7)]), "k", "valid_from", "valid_to", "v")


def test_an_emptied_folder_loses_its_rows(spark, tmp_path):
    path = timeline.store_history(history(spark, [(1, "a", dt.date(2015, 1, 1), "S", 1), (2, "a", dt.date(2015, 12, 1), "X", 0)]),
                                  str(tmp_path / "h"))
    late = spark.createDataFrame([(3, "a", dt.date(2019, 1, 1), "X", 0)], LOG)
    timeline.finish_splice(spark, path, timeline.splice_events(spark, path, late, "k", "day", "eid", ["v"], F.col("kind") == "X"))
    assert rows_of(timeline.read_history(spark, path, "k"), "k", "valid_to") == [("a", dt.date(2019, 1, 1))]
    none = spark.createDataFrame([], LOG)
    before = files(path)
    timeline.finish_splice(spark, path, timeline.splice_events(spark, path, none, "k", "day", "eid", ["v"]))
    assert files(path) == before


# ---------------------------------------------------------------- two time axes

@EASY
@given(st.lists(st.dictionaries(st.sampled_from("ab"), st.lists(st.tuples(st.integers(1, 4), st.sampled_from("xy")), max_size=4), max_size=2),
                min_size=1, max_size=3))
def test_rectangles_answer_every_day_of_both_axes(spark, loads):
    rows, plain = [], {}
    for i, lives in enumerate(loads):
        for k, spans in lives.items():
            at = i % 2
            for n, (length, v) in enumerate(spans):
                hi = SENTINEL if n + 1 == len(spans) and length == 4 else day(at + length - 1)
                rows.append((k, day(at), hi, False, v, day(20 + 5 * i)))
                plain[i, k, at] = (hi, v)
                at += length
    df = with_keys(spark.createDataFrame(rows + rows[:1], VERSIONS + ", load_day date"), "k", ["v"])
    out = timeline.bitemporal(df, "k", ["v"])
    got = rows_of(out, "k", "valid_from", "valid_to", "known_from", "known_to", "v")
    held = sorted({r[5] for r in rows})
    for k in "ab":
        for valid in range(0, 20):
            for known in range(18, 40):
                seen = [v for kk, lo, hi, a, b, v in got if kk == k and lo <= day(valid) <= hi and a <= day(known) <= b]
                last = max((d for d in held if d <= day(known)), default=None)
                want = [v for kk, lo, hi, _, v, d in rows if kk == k and d == last and lo <= day(valid) <= hi]
                assert seen == want, (k, valid, known)
    facts = spark.createDataFrame([(n, k, day(v), day(w)) for n, (k, v, w) in enumerate((k, v, w) for k in "ab" for v in (0, 3, 9) for w in (19, 22, 33))],
                                  "n int, k string, v_day date, k_day date")
    met = rows_of(timeline.known_asof(facts, out.drop("row_hash"), "k", "v_day", "k_day", how="left"), "n", "v")
    assert [n for n, _ in met] == sorted(range(18), key=str) or sorted(n for n, _ in met) == list(range(18))
    for r in facts.collect():
        want = [v for kk, lo, hi, a, b, v in got if kk == r["k"] and lo <= r["v_day"] <= hi and a <= r["k_day"] <= b]
        assert dict(met)[r["n"]] == (want[0] if want else None)


def test_rectangles_of_no_loads_and_bad_rows(spark):
    df = with_keys(spark.createDataFrame([(None, day(0), day(1), False, "x", day(9)), ("a", None, day(1), False, "x", day(9)),
                                          ("a", day(3), day(1), False, "x", day(9)), ("a", day(0), day(1), False, "x", None)],
                                         VERSIONS + ", load_day date"), "k", ["v"])
    assert timeline.bitemporal(df, "k", ["v"]).collect() == []
    with pytest.raises(ValueError, match="inner"):
        timeline.known_asof(df, df, "k", "valid_from", "load_day", how="outer")
