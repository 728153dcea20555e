"""Mergeable profiles and working days against plain Python."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from strata.operators import sketches, workdays

QUICK = dict(deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
LO, HI = dt.date(2024, 1, 1), dt.date(2024, 3, 31)


def test_merged_profiles_equal_one_over_all_rows(spark):
    df = spark.range(60_000).selectExpr(
        "id", "if(id % 10 = 0, null, double(id % 1000)) x", "string(null) e", "date_add(date'2020-01-01', int(id % 300)) d",
        "concat('v', id % 7) t", "double('nan') n", "id % 3 run")
    cols = ["id", "x", "e", "d", "t", "n"]
    runs = sketches.column_profiles(df, cols, run="run")
    assert runs.count() == 18
    got = {r["column"]: r for r in sketches.estimates(sketches.merge_profiles(runs)).collect()}
    for c, distinct in (("id", 60_000), ("x", 900), ("e", 0), ("d", 300), ("t", 7), ("n", 1)):
        assert got[c]["n_rows"] == 60_000
        assert abs(got[c]["n_distinct"] - distinct) <= distinct * sketches.DISTINCT_ERROR
    assert got["x"]["n_null"] == 6_000 and got["e"]["n_null"] == 60_000
    assert got["t"]["quantiles"] is got["e"]["quantiles"] is got["n"]["quantiles"] is None
    for r, q in zip(sketches.DECILES, got["id"]["quantiles"]):
        assert abs(q / 60_000 - r) <= sketches.RANK_ERROR
    by = sketches.merge_profiles(runs.withColumn("half", runs["run"] > 0), by=["half"])
    assert {(r["half"], r["n_rows"]) for r in by.collect()} == {(False, 20_000), (True, 40_000)}


def test_profiles_of_an_empty_table_and_of_odd_names(spark):
    empty = spark.createDataFrame([], "`a b` int, c string")
    got = sketches.estimates(sketches.column_profiles(empty, ["a b", "c"])).collect()
    assert [tuple(r) for r in got] == [("a b", 0, 0, 0, None), ("c", 0, 0, 0, None)]
    both = sketches.profile_drift(sketches.column_profiles(empty, ["a b"]),
                                  sketches.column_profiles(spark.range(3).selectExpr("int(id) `a b`"), ["a b"])).first()
    assert tuple(both) == ("a b", 0.0, None, None)


def test_drift_between_runs(spark):
    before = spark.range(10_000).selectExpr("double(id) moved", "double(id) same", "id gone", "string(id % 5) fewer")
    after = spark.range(10_000).selectExpr("double(id + 5000) moved", "double(id) same", "id came",
                                           "if(id % 2 = 0, null, '1') fewer")
    a = sketches.column_profiles(before, before.columns)
    b = sketches.column_profiles(after, after.columns)
    got = {r["column"]: r for r in sketches.profile_drift(a, b).collect()}
    limit = 2 * (sketches.RANK_ERROR + 1 / sketches.GRID)
    assert abs(got["moved"]["rank_shift"] - 0.5) <= limit and got["same"]["rank_shift"] <= limit
    assert got["fewer"]["null_shift"] == 0.5 and abs(got["fewer"]["distinct_ratio"] - 0.2) < 0.01
    assert got["fewer"]["rank_shift"] is None
    assert tuple(got["gone"])[1:] == tuple(got["came"])[1:] == (None, None, None)


def calendar(spark, holidays):
    return workdays.working_calendar(
        spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "country string"),
        spark.createDataFrame(holidays, "country string, date date"), LO, HI)


@settings(max_examples=8, **QUICK)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.one_of(st.none(), st.dates(LO, HI))), max_size=12),
       st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.one_of(st.none(), st.dates(LO, HI + dt.timedelta(9))),
                          st.one_of(st.none(), st.dates(LO, HI))), min_size=1, max_size=10), st.integers(1, 30))
def test_working_days_match_brute_force(spark, holidays, spans, n):
    off = set(holidays)

    def works(c, d):
        return d.weekday() < 5 and (c, d) not in off

    def known(c, *days):
        return c in ("A", "B") and all(d is not None and LO <= d <= HI for d in days)

    def between(c, a, b):
        if not known(c, a, b):
            return None
        lo, hi = min(a, b), max(a, b)
        k = sum(works(c, lo + dt.timedelta(i)) for i in range(1, (hi - lo).days + 1))
        return k if a <= b else -k

    def due(c, a):
        if not known(c, a):
            return None
        later = [d for d in (a + dt.timedelta(i) for i in range(1, (HI - a).days + 1)) if works(c, d)]
        return later[n - 1] if len(later) >= n else None

    cal = calendar(spark, holidays)
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "i int, c string, a date, b date")
    got = workdays.add_working_days(workdays.working_days_between(df, cal, "c", "a", "b"), cal, "c", "a", n)
    assert sorted(map(tuple, got.collect())) == [(i, c, a, b, between(c, a, b), due(c, a)) for i, (c, a, b) in enumerate(spans)]


def test_empty_calendars(spark):
    none = workdays.working_calendar(spark.createDataFrame([], "country string"),
                                     spark.createDataFrame([], "country string, date date"), LO, HI)
    assert none.collect() == []
    upside = workdays.working_calendar(spark.createDataFrame([("A",)], "country string"),
                                       spark.createDataFrame([], "country string, date date"), HI, LO)
    assert upside.collect() == []
    with pytest.raises(ValueError):
        workdays.add_working_days(spark.createDataFrame([], "c string, a date"), none, "c", "a", 0)
