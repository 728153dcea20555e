"""Property tests: the Spark operators against brute-force Python on random logs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import marts
from strata.operators.history import SENTINEL, scd2

BASE = dt.date(2026, 1, 1)
ONE = dt.timedelta(days=1)

events = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40),
              st.sampled_from(["S", "S", "S", "X"]), st.integers(0, 9)),
    min_size=1, max_size=25)


def brute_scd2(rows, same_day):
    """Reference rule written plainly: per key, sort state events by (day, id);
    valid_to = next state day - 1, the last one ends on the last exit or never."""
    out = []
    for k in {r[1] for r in rows}:
        st_rows = sorted((r for r in rows if r[1] == k and r[3] == "S"), key=lambda r: (r[2], r[0]))
        if same_day == "last":
            st_rows = [r for i, r in enumerate(st_rows)
                       if i + 1 == len(st_rows) or st_rows[i + 1][2] != r[2]]
        exits = [r[2] for r in rows if r[1] == k and r[3] == "X"]
        for i, r in enumerate(st_rows):
            if i + 1 < len(st_rows):
                end = st_rows[i + 1][2] - ONE
            else:
                end = max(exits) if exits else SENTINEL
            out.append((k, r[2], end, r[4]))
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from(["last", "fail"]))
def test_scd2_matches_brute_force(spark, evs, same_day):
    rows = [(i, k, BASE + d * ONE, kind, v) for i, (k, d, kind, v) in enumerate(evs)]
    df = spark.createDataFrame(rows, "eid int, k string, day date, kind string, v int")
    got = scd2(df, "k", "day", "eid", ["v"], is_exit=F.col("kind") == "X", same_day=same_day)
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["v"]) for r in got.collect())
    assert got == brute_scd2(rows, same_day)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 800)), min_size=1,
                max_size=20),
       st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 900)), min_size=1,
                max_size=30),
       st.sampled_from(["year", "month"]))
def test_asof_matches_brute_force(spark, starts, facts, bucket):
    # versions: disjoint per key, built from sorted distinct starts; last is open-ended
    vs = []
    for k in {s[0] for s in starts}:
        days = sorted({d for kk, d in starts if kk == k})
        for i, d in enumerate(days):
            end = BASE + (days[i + 1] - 1) * ONE if i + 1 < len(days) else SENTINEL
            vs.append((k, BASE + d * ONE, end, f"{k}{i}"))
    fx = [(i, k, BASE + d * ONE) for i, (k, d) in enumerate(facts)]
    vdf = spark.createDataFrame(vs, "k string, valid_from date, valid_to date, tag string")
    fdf = spark.createDataFrame(fx, "id int, k string, d date")
    got = sorted((r["id"], r["tag"]) for r in
                 marts.asof(fdf, vdf, "k", "d", how="left", bucket=bucket).collect())
    want = []
    for i, k, d in fx:
        tags = [t for kk, lo, hi, t in vs if kk == k and lo <= d <= hi]
        want.append((i, tags[0] if tags else None))
    assert got == sorted(want, key=lambda x: (x[0], x[1] or ""))


def brute_rehire(rows, same_day):
    """rehire=True written plainly: per key, state days (last event of a day wins in
    "last" mode) and exit days in one sorted list (state before exit on a day); a
    state version ends the day before the next state day, or on the next exit day."""
    out = []
    for k in {r[1] for r in rows}:
        states = sorted((r for r in rows if r[1] == k and r[3] == "S"), key=lambda r: (r[2], r[0]))
        lasts = [r for i, r in enumerate(states) if i + 1 == len(states) or states[i + 1][2] != r[2]]
        earlier = [r for r in states if r not in lasts]
        exits = sorted({r[2] for r in rows if r[1] == k and r[3] == "X"})
        seq = sorted([(r[2], 0, r) for r in lasts] + [(d, 1, None) for d in exits],
                     key=lambda t: (t[0], t[1]))
        for i, (d, is_x, r) in enumerate(seq):
            if is_x:
                continue
            if i + 1 == len(seq):
                end = SENTINEL
            elif seq[i + 1][1]:
                end = seq[i + 1][0]
            else:
                end = seq[i + 1][0] - ONE
            out.append((k, d, end, r[4]))
        if same_day == "fail":
            out += [(k, r[2], r[2] - ONE, r[4]) for r in earlier]
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from(["last", "fail"]))
def test_scd2_rehire_matches_brute_force(spark, evs, same_day):
    rows = [(i, k, BASE + d * ONE, kind, v) for i, (k, d, kind, v) in enumerate(evs)]
    df = spark.createDataFrame(rows, "eid int, k string, day date, kind string, v int")
    got = scd2(df, "k", "day", "eid", ["v"], is_exit=F.col("kind") == "X", same_day=same_day,
               rehire=True)
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["v"]) for r in got.collect())
    assert got == brute_rehire(rows, same_day)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["x", "y", "z"]), max_size=6),
       st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["x", "y", "z"]), max_size=6))
def test_apply_snapshot_matches_brute_force(spark, current, snapshot):
    from strata.operators.history import apply_snapshot
    from strata.operators.keys import with_keys
    start, load = BASE, BASE + 100 * ONE
    hist_rows = [(k, start - 50 * ONE, start - ONE, False, "old") for k in current]
    hist_rows += [(k, start, SENTINEL, True, v) for k, v in current.items()]
    hist = spark.createDataFrame(hist_rows or [("zz", start, start, False, "q")],
                                 "k string, valid_from date, valid_to date, is_current boolean, v string")
    hist = with_keys(hist, "k", ["v"]).drop("version_sk")
    snap = spark.createDataFrame(list(snapshot.items()) or [("none", "x")], "k string, v string")
    if not snapshot:
        snap = snap.filter("k = 'never'")
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["is_current"], r["v"]) for r in
                 apply_snapshot(hist, snap, "k", ["v"], load).collect())
    want = [r[:5] for r in hist_rows if not r[3]] or [("zz", start, start, False, "q")]
    for k, v in current.items():
        same = snapshot.get(k) == v
        want.append((k, start, SENTINEL if same else load - ONE, same, v))
    for k, v in snapshot.items():
        if current.get(k) != v:
            want.append((k, load, SENTINEL, True, v))
    assert got == sorted(want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 400), st.integers(0, 120),
                          st.booleans(), st.sampled_from(["p", "q"])), min_size=1, max_size=15))
def test_snapshot_matches_brute_force(spark, spans):
    import calendar as cal
    rows = [(k, BASE + s * ONE, SENTINEL if open_ else BASE + (s + n) * ONE, g)
            for k, s, n, open_, g in spans]
    lo, hi = BASE + 20 * ONE, BASE + 380 * ONE
    df = spark.createDataFrame(rows, "k string, valid_from date, valid_to date, g string")
    got = sorted((r["month_end"], r["g"], r["headcount"]) for r in
                 marts.snapshot(df, lo, hi, by=["g"]).collect())
    ends, d = [], lo
    while d <= hi:
        e = d.replace(day=cal.monthrange(d.year, d.month)[1])
        if lo <= e <= hi:
            ends.append(e)
        d = e + ONE
    want = {}
    for _, vf, vt, g in rows:
        for e in ends:
            if vf <= e <= vt:
                want[(e, g)] = want.get((e, g), 0) + 1
    assert got == sorted((e, g, n) for (e, g), n in want.items())


maybe_events = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5)),
                                  st.integers(0, 2), st.sampled_from(["S", "S", "S", "X"]), st.integers(0, 1)),
                        min_size=1, max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(maybe_events)
def test_versions_exits_and_rejects_are_all_events(spark, evs):
    from strata.operators.history import scd2_rejects
    rows = [(k, None if d is None else BASE + d * ONE, o, kind, v) for k, d, o, kind, v in evs]
    df = spark.createDataFrame(rows, "k string, day date, o int, kind string, v int")
    args = dict(key="k", date="day", order="o", state=["v"], is_exit=F.col("kind") == "X")
    got = [(r["k"], r["valid_from"], r["o"], "S", r["v"]) for r in scd2(df, same_day="fail", **args).collect()]
    got += [(r["k"], r["day"], r["o"], "X" if r["is_exit"] else "S", r["v"]) for r in scd2_rejects(df, **args).collect()]
    got += [r for r in rows if r[3] == "X" and r[0] is not None and r[1] is not None]
    assert sorted(map(str, got)) == sorted(map(str, rows))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), min_size=1, max_size=5, unique_by=lambda t: t[0]),
       st.lists(st.dictionaries(st.sampled_from("abc"), st.sampled_from("xyz"), min_size=1, max_size=3), min_size=1, max_size=3),
       st.lists(st.integers(0, 2), min_size=3, max_size=3))
def test_chained_snapshots_keep_the_invariants(spark, start, snaps, steps):
    from strata.operators import gates
    from strata.operators.history import apply_snapshot
    from strata.operators.keys import with_keys
    ends = [SENTINEL, BASE + 3 * ONE]
    rows = [(k, BASE - 9 * ONE, ends[i % 2], i % 2 == 0, v) for i, (k, v) in enumerate(start)]
    hist = with_keys(spark.createDataFrame(
        rows, "k string, valid_from date, valid_to date, is_current boolean, v string"), "k", ["v"]).drop("version_sk")
    load = BASE
    for snap, step in zip(snaps, steps):
        load = load + step * ONE                            # a step of 0 loads the same day again
        hist = apply_snapshot(hist, spark.createDataFrame(list(snap.items()), "k string, v string"), "k", ["v"], load)
        row = gates.history_violations(hist, "k").first()
        assert (row["inverted"], row["overlaps"], row["multi_current"]) == (0, 0, 0)
        assert gates.duplicate_keys(hist, ["k", "valid_from"]).count() == 0
        alive = {r["k"]: r["v"] for r in hist.collect() if r["valid_from"] <= load <= r["valid_to"]}
        assert alive == snap
