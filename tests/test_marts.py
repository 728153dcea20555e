import datetime as dt

from strata.operators import calendar, marts
from strata.operators.history import SENTINEL

D = dt.date
VSCHEMA = "k string, valid_from date, valid_to date, st string"


def _versions(spark):
    return spark.createDataFrame([
        ("A", D(2020, 1, 1), D(2021, 6, 30), "x"),
        ("A", D(2021, 7, 1), SENTINEL, "y"),
        ("B", D(2022, 3, 5), D(2022, 3, 20), "z"),       # lives inside one month
    ], VSCHEMA)


def test_asof_picks_the_alive_version_and_never_multiplies(spark):
    facts = spark.createDataFrame([
        (1, "A", D(2020, 5, 1)), (2, "A", D(2021, 6, 30)), (3, "A", D(2021, 7, 1)),
        (4, "A", D(2030, 1, 1)), (5, "B", D(2022, 4, 1)), (6, "C", D(2022, 1, 1)),
    ], "id int, k string, d date")
    inner = {r["id"]: r["st"] for r in marts.asof(facts, _versions(spark), "k", "d").collect()}
    assert inner == {1: "x", 2: "x", 3: "y", 4: "y"}
    left = marts.asof(facts, _versions(spark), "k", "d", how="left").collect()
    assert len(left) == 6
    assert {r["id"]: r["st"] for r in left}[5] is None


def test_snapshot_counts_month_ends_inclusive(spark):
    snap = marts.snapshot(_versions(spark), D(2021, 5, 1), D(2021, 8, 31), by=["st"])
    got = sorted((r["month_end"], r["st"], r["headcount"]) for r in snap.collect())
    assert got == [(D(2021, 5, 31), "x", 1), (D(2021, 6, 30), "x", 1),
                   (D(2021, 7, 31), "y", 1), (D(2021, 8, 31), "y", 1)]
    # a version between two month ends is never counted (no descending sequence)
    assert marts.snapshot(_versions(spark), D(2022, 1, 1), D(2022, 12, 31), by=["k"]).filter(
        "k = 'B'").count() == 0


def test_changes_classifies(spark):
    cur = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "k string, row_hash string")
    inc = spark.createDataFrame([("a", "h1"), ("b", "hX"), ("d", "h4")], "k string, row_hash string")
    got = {r["k"]: r["change"] for r in marts.changes(cur, inc, "k").collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "gone", "d": "new"}


def test_changes_between_matches_changes(spark):
    v = spark.createDataFrame([
        ("a", D(2020, 1, 1), SENTINEL, "h1"),
        ("b", D(2020, 1, 1), D(2020, 12, 31), "h2"), ("b", D(2021, 1, 1), SENTINEL, "h3"),
        ("c", D(2020, 1, 1), D(2020, 6, 30), "h4"),
        ("d", D(2021, 3, 1), SENTINEL, "h5"),
    ], "k string, valid_from date, valid_to date, row_hash string")
    t1, t2 = D(2020, 6, 30), D(2021, 6, 30)
    got = {r["k"]: r["change"] for r in marts.changes_between(v, "k", t1, t2).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "gone", "d": "new"}
    alive = lambda t: v.filter((v.valid_from <= t) & (v.valid_to >= t))
    via_join = {r["k"]: r["change"] for r in marts.changes(alive(t1), alive(t2), "k").collect()}
    assert via_join == got


def test_first_key_with_versions(spark):
    out = marts.first_key_with_versions(_versions(spark), "k", 2).collect()
    assert {r["k"] for r in out} == {"A"} and len(out) == 2


def test_dim_date_merges_same_day_holidays(spark):
    hol = spark.createDataFrame([
        (D(2026, 1, 1), "New Year", "GB"), (D(2026, 1, 1), "Another", "GB"),
        (D(2026, 1, 2), "Other land", "US")], "holiday_date date, holiday_name string, "
                                              "country_code string")
    dd = calendar.dim_date(spark, D(2026, 1, 1), D(2026, 1, 3), hol, "GB").orderBy("date").collect()
    assert [r["is_public_holiday"] for r in dd] == [True, False, False]
    assert dd[0]["holiday_name"] == "Another" and dd[0]["n_holidays"] == 2
    assert [r["is_weekend"] for r in dd] == [False, False, True]   # 2026-01-03 is a Saturday


def test_asof_rejects_clashing_columns(spark):
    import pytest
    facts = spark.createDataFrame([(1, "A", D(2020, 5, 1), "f")], "id int, k string, d date, st string")
    with pytest.raises(ValueError, match="st"):
        marts.asof(facts, _versions(spark), "k", "d")


def test_any_horizon_gives_the_same_join(spark):
    """The horizon only bounds the buckets: facts and versions after it still meet."""
    import datetime as dt
    versions = spark.createDataFrame([("a", dt.date(2019, 5, 1), dt.date(2020, 2, 1), 1), ("a", dt.date(2020, 2, 2), dt.date(2021, 7, 1), 2),
                                      ("a", dt.date(2021, 7, 2), dt.date(9999, 12, 31), 3), ("b", dt.date(2022, 1, 1), dt.date(2022, 1, 1), 4)],
                                     "k string, valid_from date, valid_to date, tag int")
    days = [(k, dt.date(y, m, 2)) for k in ("a", "b", None) for y in (2018, 2019, 2020, 2021, 2022, 2040) for m in (1, 2, 7)] + [("a", None)]
    facts = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(days)], "n int, k string, d date")
    want = [(i, next((t for kk, lo, hi, t in (("a", (2019, 5, 1), (2020, 2, 1), 1), ("a", (2020, 2, 2), (2021, 7, 1), 2),
                                               ("a", (2021, 7, 2), (9999, 12, 31), 3), ("b", (2022, 1, 1), (2022, 1, 1), 4))
                      if d and kk == k and dt.date(*lo) <= d <= dt.date(*hi)), None)) for i, (k, d) in enumerate(days)]
    for horizon in (None, dt.date(1990, 1, 1), dt.date(2020, 6, 1), dt.date(2050, 1, 1)):
        for bucket in ("year", "month"):
            got = marts.asof(facts, versions, "k", "d", how="left", bucket=bucket, horizon=horizon).collect()
            assert sorted((r["n"], r["tag"]) for r in got) == want
