"""The life-cycle gate against plain Python."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from strata.operators import gates, lifecycle
from strata.operators.lifecycle import LifeCycle

CYCLE = LifeCycle(starts=frozenset({"HIRE", "REHIRE"}), ends=frozenset({"EXIT"}), follows={
    "HIRE": frozenset({"MOVE", "EXIT"}), "MOVE": frozenset({"MOVE", "EXIT"}), "EXIT": frozenset({"REHIRE"}),
    "REHIRE": frozenset({"MOVE", "EXIT"})})
SCHEMA = "k string, d date, o int, kind string"
BASE = dt.date(2024, 1, 1)


def brute(rows):
    out = [(k, d, o, None, kind, "null_key" if k is None else "null_day") for k, d, o, kind in rows if k is None or d is None]
    for key in {r[0] for r in rows if r[0] is not None}:
        prev = first = None
        for k, d, o, kind in sorted((r for r in rows if r[0] == key and r[1]), key=lambda r: (r[1], r[2], r[3] or "")):
            if kind not in CYCLE.kinds():
                why = "unknown_kind"
            elif first is None:
                why = None if kind in CYCLE.starts else "not_started"
            elif kind in CYCLE.follows.get(prev, ()):
                why = None
            else:
                why = "second_start" if kind in CYCLE.starts else "after_end" if prev in CYCLE.ends else "bad_transition"
            if why:
                out.append((k, d, o, prev if first is not None else None, kind, why))
            prev = first = kind
            first = True
    return sorted(out, key=str)


@settings(max_examples=10, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0, 0, 1, 5, None]), st.integers(0, 3),
                          st.sampled_from(["HIRE", "MOVE", "EXIT", "REHIRE", "OTHER", None])), max_size=14))
def test_violations_match_brute_force(spark, evs):
    rows = [(k, None if d is None else BASE + dt.timedelta(days=d), o, kind) for k, d, o, kind in evs]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, lifecycle.lifecycle_violations(df, CYCLE, "k", "d", "o", "kind").collect()), key=str)
    assert got == brute(rows)


def test_every_planted_break_is_counted_by_kind(spark):
    d = [BASE + dt.timedelta(days=i) for i in range(9)]
    rows = [("fine", d[0], 1, "HIRE"), ("fine", d[1], 2, "EXIT"), ("fine", d[2], 3, "REHIRE"), ("fine", d[2], 4, "MOVE"),
            ("late", d[0], 1, "MOVE"), ("twice", d[0], 1, "HIRE"), ("twice", d[0], 2, "HIRE"),
            ("gone", d[0], 1, "HIRE"), ("gone", d[1], 2, "EXIT"), ("gone", d[5], 3, "MOVE"),
            ("odd", d[0], 1, "HIRE"), ("odd", d[1], 2, "OTHER"), ("odd", d[2], 3, "MOVE"), (None, d[0], 1, "HIRE"), ("x", None, 1, "HIRE")]
    found = lifecycle.lifecycle_violations(spark.createDataFrame(rows, SCHEMA), CYCLE, "k", "d", "o", "kind")
    counts = lifecycle.lifecycle_counts(found)
    assert counts.first().asDict() == {"null_key": 1, "null_day": 1, "unknown_kind": 1, "not_started": 1, "second_start": 1,
                                       "after_end": 1, "bad_transition": 1}
    with pytest.raises(gates.QualityError, match="after_end=1"):
        gates.enforce(counts, require_rows=False)
    none = lifecycle.lifecycle_violations(spark.createDataFrame([], SCHEMA), CYCLE, "k", "d", "o", "kind")
    assert none.collect() == [] and set(lifecycle.lifecycle_counts(none).first()) == {0}


def test_hot_keys_meet_as_days(spark):
    """The window over the key reads one row a day; the others are partitioned by key and day."""
    df = spark.range(5000).selectExpr("'hot' k", "date_add(date'2024-01-01', int(id % 4)) d", "int(id) o", "if(id < 1, 'HIRE', 'MOVE') kind")
    found = lifecycle.lifecycle_violations(df, CYCLE, "k", "d", "o", "kind")
    assert found.collect() == []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [lag(_last" in plan and "(_at" in plan
