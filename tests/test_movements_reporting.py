"""Reconciled headcount and reporting lines against plain Python."""

import datetime as dt
import random

from strata.operators.movements import headcount_movements
from strata.operators.reporting import reporting_lines

LO, HI = dt.date(2024, 1, 1), dt.date(2024, 6, 30)
ENDS = [dt.date(2023, 12, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 30),
        dt.date(2024, 5, 31), dt.date(2024, 6, 30)]
LEVELS = [("a", "b"), ("a",), ("b",), ()]
SCHEMA = "k int, valid_from date, valid_to date, a string, b string"


def brute_movements(rows):
    out = {}
    for level in LEVELS:
        def group(r):
            return tuple(r[3 + "ab".index(c)] if c in level else None for c in "ab")
        for prev, end in zip(ENDS, ENDS[1:]):
            was = {r[0]: group(r) for r in rows if None not in r[:3] and r[1] <= prev <= r[2]}
            now = {r[0]: group(r) for r in rows if None not in r[:3] and r[1] <= end <= r[2]}
            for k in was.keys() | now.keys():
                for g, at in ((was.get(k), 0), (now.get(k), 5)):
                    if g is not None:
                        row = out.setdefault((",".join(level) or "all", end, *g), [0] * 6)
                        row[at] += 1
                        if k in was and k in now:
                            row[3 if at == 0 else 2] += was[k] != now[k]
                        else:
                            row[4 if at == 0 else 1] += 1
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def test_movements_equal_brute_force_and_add_up(spark):
    rnd = random.Random(3)
    rows = [(None, LO, HI, "x", "y"), (99, None, HI, "x", "y")]
    for k in range(60):
        day = LO + dt.timedelta(rnd.randrange(-60, 120))
        for _ in range(rnd.randrange(1, 7)):
            end = day + dt.timedelta(rnd.randrange(0, 60))
            if rnd.random() < 0.15:
                end = dt.date(9999, 12, 31)
            rows.append((k, day, end, rnd.choice(["x", "y", None]), rnd.choice(["p", "q"])))
            if end.year == 9999:
                break
            day = end + dt.timedelta(rnd.choice([1, 1, 1, 40]))
    got = headcount_movements(spark.createDataFrame(rows, SCHEMA), "k", LO, HI, LEVELS)
    got = [tuple(r) for r in got.select("level", "month_end", "a", "b", "opening", "entries", "transfers_in",
                                        "transfers_out", "exits", "closing").collect()]
    assert sorted(got, key=str) == brute_movements(rows)
    assert all(r[4] + r[5] + r[6] - r[7] - r[8] == r[9] for r in got)
    assert any(r[6] for r in got) and any(r[5] for r in got) and any(r[8] for r in got)


def test_movements_of_an_empty_history(spark):
    assert headcount_movements(spark.createDataFrame([], SCHEMA), "k", LO, HI, LEVELS).count() == 0


def brute_lines(rows):
    boss = {}
    for k, m in rows:
        if k is not None:
            boss[k] = min((x for x in (boss.get(k), m) if x is not None), default=None)
    out = []
    for k, m in boss.items():
        way = [k]
        while boss[way[-1]] in boss and boss[way[-1]] not in way:
            way.append(boss[way[-1]])
        last = boss[way[-1]]
        if last not in boss:
            out.append((k, m, way[-1], len(way) - 1, "line"))
        else:
            loop = way[way.index(last):]
            out.append((k, m, min(loop), None, "loop" if k in loop else "into_loop"))
    return sorted(out, key=str)


def check_lines(spark, rows):
    got = reporting_lines(spark.createDataFrame(rows, "k long, m long, root string").repartition(4), "k", "m").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_lines([r[:2] for r in rows])


def test_lines_loops_and_ways_into_them(spark):
    rows = [(1, None), (2, 1), (3, 2), (3, None), (3, 7), (4, 99), (None, 1), (5, 5), (6, 5), (10, 11), (11, 12), (12, 10),
            (2, 1)]
    rows += [(100 + i, 99 + i if i else 10) for i in range(70)]           # a long way into a loop
    rows += [(300 + i, 300 + (i + 1) % 37) for i in range(37)]            # a long loop
    rows += [(500 + i, 499 + i if i else None) for i in range(45)]        # a deep line
    rows += [(600 + i, 1) for i in range(50)]                             # a hot manager
    check_lines(spark, [(*r, "clash") for r in rows])


def test_random_lines(spark):
    rnd = random.Random(5)
    check_lines(spark, [(k, rnd.choice([None, *range(220)]), "") for k in range(200)])


def test_lines_of_an_empty_table(spark):
    assert reporting_lines(spark.createDataFrame([], "k long, m long"), "k", "m").count() == 0
