import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import gates


def test_profile_fuses_counts_and_enforce_lists_all(spark):
    df = spark.createDataFrame([("a", None), ("a", "2026-01-01"), (None, "x"), ("b", "bad")],
                               "k string, d string")
    rules = {"null_day": F.col("d").isNull(),
             "bad_day": F.col("d").isNotNull() & F.try_to_date("d", "yyyy-MM-dd").isNull()}
    row = gates.profile(df, rules, key="k").first().asDict()
    assert row == {"n_rows": 4, "null_keys": 1, "duplicate_keys": 1, "null_day": 1, "bad_day": 2}
    with pytest.raises(gates.QualityError) as e:
        gates.enforce(gates.profile(df, rules, key="k"))
    assert set(e.value.violations) == {"null_keys", "duplicate_keys", "null_day", "bad_day"}


def test_enforce_passes_and_flags_empty(spark):
    ok = spark.createDataFrame([("a",)], "k string")
    assert gates.enforce(gates.profile(ok, {}, key="k"))["n_rows"] == 1
    empty = spark.createDataFrame([], "k string")
    with pytest.raises(gates.QualityError):
        gates.enforce(gates.profile(empty, {}))


def test_duplicate_and_unknown_values(spark):
    df = spark.createDataFrame([(1, "HIRE"), (1, "hire"), (2, None), (3, "HIRE")],
                               "id int, t string")
    assert [(r["id"], r["n"]) for r in gates.duplicate_keys(df, "id").collect()] == [(1, 2)]
    unk = sorted((r["t"] or "", r["n"]) for r in
                 gates.unknown_values(df, "t", ["HIRE"]).collect())
    assert unk == [("", 1), ("hire", 1)]


def test_start_violations(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("A", "HIRE", d(2026, 1, 1), "1"), ("A", "PROMOTION", d(2026, 2, 1), "2"),
        ("B", "PROMOTION", d(2026, 1, 1), "3"), ("B", "HIRE", d(2026, 2, 1), "4"),
        ("C", "PROMOTION", d(2026, 1, 1), "5"),
        ("D", "HIRE", d(2026, 1, 1), "6"), ("D", "HIRE", d(2026, 3, 1), "7"),
    ], "emp string, t string, day date, eid string")
    out = {r["emp"]: (r["n_start"], r["first_type"]) for r in
           gates.start_violations(df, "emp", "t", ["day", "eid"], "HIRE").collect()}
    assert out == {"B": (1, "PROMOTION"), "C": (0, "PROMOTION"), "D": (2, "HIRE")}


def test_split_quarantine_is_complementary(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -1)], "id int, x int")
    good, bad = gates.split_quarantine(df, {"null_x": F.col("x").isNull(),
                                            "negative": F.col("x") < 0})
    assert [r["id"] for r in good.collect()] == [2]
    assert sorted((r["id"], tuple(r["_violations"])) for r in bad.collect()) == [
        (1, ("null_x",)), (3, ("negative",))]


def test_interval_and_row_count(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2026, 1, 2), d(2026, 1, 1)), (d(2026, 1, 1), d(2026, 1, 1))],
                               "a date, b date")
    assert gates.interval_violations(df, "a", "b").count() == 1
    assert gates.row_count_check(df, df, "a").count() == 0
    more = df.unionByName(df.filter("a = DATE'2026-01-02'")).filter("a > DATE'2026-01-01'")
    rows = gates.row_count_check(df, more, "a").collect()
    assert sorted((r["a"].day, r["n_in"], r["n_out"]) for r in rows) == [(1, 1, 0), (2, 1, 2)]


def test_untrimmed_counts(spark):
    df = spark.createDataFrame([(" a", "b"), ("a", "b "), ("\ta", "b")], "x string, y string")
    row = gates.untrimmed_counts(df).first()
    assert (row["untrimmed_x"], row["untrimmed_y"]) == (1, 1)


def test_history_violations(spark):
    d = dt.date
    v = spark.createDataFrame([
        ("A", d(2026, 1, 1), d(2026, 1, 31), False), ("A", d(2026, 2, 1), d(9999, 12, 31), True),
        ("B", d(2026, 1, 1), d(2026, 2, 10), False), ("B", d(2026, 2, 1), d(9999, 12, 31), True),
        ("C", d(2026, 1, 1), d(2026, 1, 10), False), ("C", d(2026, 3, 1), d(9999, 12, 31), True),
        ("D", d(2026, 1, 5), d(2026, 1, 4), True), ("D", d(2026, 2, 1), d(9999, 12, 31), True),
    ], "k string, valid_from date, valid_to date, is_current boolean")
    row = gates.history_violations(v, "k").first().asDict()
    # D's inverted version covers no day, so nothing starts late after it
    assert row == {"inverted": 1, "overlaps": 1, "gaps": 1, "multi_current": 1}


def test_versions_inside_a_longer_one_overlap_it(spark):
    d = dt.date
    v = spark.createDataFrame([
        ("A", d(2026, 1, 1), d(2026, 12, 31), False), ("A", d(2026, 2, 1), d(2026, 2, 10), False),
        ("A", d(2026, 3, 1), d(2026, 3, 10), False), ("A", d(2027, 1, 1), d(9999, 12, 31), True),
        ("B", d(2026, 1, 1), d(2026, 1, 5), False), ("B", d(2026, 1, 1), d(2026, 1, 9), False),
    ], "k string, valid_from date, valid_to date, is_current boolean")
    row = gates.history_violations(v, "k").first().asDict()
    assert row == {"inverted": 0, "overlaps": 3, "gaps": 0, "multi_current": 0}


def test_failures_lists_every_rule_with_its_count(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "x")], "k int, v string")
    row = gates.profile(df, {"null_v": F.col("v").isNull(), "x": F.col("v") == "x"}, key="k")
    assert gates.failures(row, prefix="t.") == {"t.null_keys": 1, "t.duplicate_keys": 1, "t.null_v": 1, "t.x": 2}
    assert gates.failures(gates.profile(df.limit(0), {})) == {"empty_input": 1}
