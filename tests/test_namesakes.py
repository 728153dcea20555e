"""Names one slip apart against a letter-by-letter comparison, and recall and precision on planted ones."""

import random

from strata.operators.namesakes import namesakes


def slip(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        diff = [i for i in range(len(a)) if a[i] != b[i]]
        return len(diff) == 1 or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]])
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    own = {(k, " ".join((n or "").upper().split()) or None) for k, n in rows if k is not None}
    out = []
    for k, n in own:
        same = [x for x, m in own if n is not None and m == n]
        near = [x for x, m in own if n is not None and m is not None and slip(n, m)]
        out.append((k, n, max(len(same) - 1, 0), len(near), min([k, *same, *near])))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(k, n, "x") for k, n in rows], "k long, n string, name string")
    assert sorted((tuple(r) for r in namesakes(df, "k", "n").collect()), key=str) == brute(rows)


def test_short_names_equal_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice("ab c") for _ in range(rnd.randrange(0, 7)))) for i in range(150)]
    check(spark, rows + [(None, "ab"), (3, None), (3, "ab"), (3, "ab"), (200, " "), (201, "ä b"), (202, "a  b"), (203, "é" * 300),
                         (204, "é" * 299), (205, "aab"), (206, "aba")] + [(300 + i, "hot name") for i in range(80)] + [(400, "hto name")])


def test_planted_misspellings_are_found_and_nothing_else(spark):
    rnd = random.Random(4)
    names = {k: "".join(rnd.choice("abcdefghijklmnop") for _ in range(14)) for k in range(400)}
    rows, bad = list(names.items()), {}
    for k in range(0, 400, 8):
        n, i = names[k], rnd.randrange(1, 12)
        bad[1000 + k] = rnd.choice([n[:i] + n[i + 1:], n[:i] + "z" + n[i:], n[:i] + "z" + n[i + 1:], n[:i] + n[i + 1] + n[i] + n[i + 2:]])
    got = {r["k"]: r["first_key"] for r in namesakes(spark.createDataFrame(rows + list(bad.items()), "k long, n string"), "k", "n").collect()}
    assert all(got[k] == k - 1000 for k in bad)                          # recall 1
    assert all(got[k] == k for k in names)                               # precision 1


def test_empty_table(spark):
    assert namesakes(spark.createDataFrame([], "k long, n string"), "k", "n").count() == 0
