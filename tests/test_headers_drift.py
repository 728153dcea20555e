"""CSV bound by header, and VARIANT landing with its drift report."""

import csv
import io
import json
import os

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from strata.sources import drift, files, headers

QUICK = dict(deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_columns_follow_each_files_header(spark, tmp_dir):
    put(tmp_dir, "a.csv", "id,name\n1,x\n2\n3,y,z\n")
    put(tmp_dir, "b.csv", "\n\ufeffNAME, id\nq,5\n")
    put(tmp_dir, "x y/c[1].csv", "id,extra\n7,8\n")
    put(tmp_dir, "headeronly.csv", "name,id,more\n")
    put(tmp_dir, "empty.csv", "")
    got = headers.scan_csv_by_name(spark, tmp_dir, ["id", "name"])
    assert sorted((r["id"], r["name"], r[files.CORRUPT], ",".join(r[headers.HEADER])) for r in got.collect()) == [
        ("1", "x", None, "id,name"), ("2", None, "2", "id,name"), ("3", "y", "3,y,z", "id,name"),
        ("5", "q", None, "NAME,id"), ("7", None, None, "id,extra")]
    report = {r["header"]: tuple(r)[1:] for r in headers.header_report(got, ["id", "name"]).collect()}
    assert report == {"id,name": (None, None, 3, 2), "NAME,id": (None, None, 1, 0), "id,extra": ("name", "extra", 1, 0)}
    assert got.select("id", files.CORRUPT).filter(f"{files.CORRUPT} IS NOT NULL").count() == 2


def test_files_of_other_headers_are_not_opened(spark, tmp_dir):
    put(tmp_dir, "a.csv", "id,name\n1,x\n")
    put(tmp_dir, "b.csv", "name,id\nx,2\n")
    plan = headers.scan_csv_by_name(spark, tmp_dir, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("file_path") >= 2


def test_landings_without_lines_and_doubled_names(spark, tmp_dir):
    put(tmp_dir, "none/empty.csv", "")
    assert headers.file_headers(spark, os.path.join(tmp_dir, "none")) == {}
    none = headers.scan_csv_by_name(spark, os.path.join(tmp_dir, "none"), ["id"])
    assert none.collect() == [] and none.columns == ["id", files.CORRUPT, headers.HEADER]
    assert headers.header_report(none, ["id"]).collect() == []
    put(tmp_dir, "twice/a.csv", "id,ID\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        headers.scan_csv_by_name(spark, os.path.join(tmp_dir, "twice"), ["id"])
    put(tmp_dir, "blank/a.csv", "id,\n1,2\n")
    assert headers.scan_csv_by_name(spark, os.path.join(tmp_dir, "blank"), ["id", "_c1"]).first()["_c1"] == "2"


def test_big_files_are_not_read_through(spark, tmp_dir):
    """A task ends at its first line, and the session's setting is put back."""
    own = spark.conf.get("spark.sql.files.openCostInBytes")
    put(tmp_dir, "a.csv", "id\n" + "1\n" * 50_000)
    assert list(headers.file_headers(spark, tmp_dir)) == [("id",)]
    assert spark.conf.get("spark.sql.files.openCostInBytes") == own


NAMES = ["a", "b", "c", "d e"]


@settings(max_examples=8, **QUICK)
@given(st.lists(st.tuples(st.permutations(NAMES), st.integers(1, 4), st.lists(st.text("xyz 1", min_size=1, max_size=3).map(
    lambda t: t.strip() or "x"), min_size=4, max_size=4)), min_size=1, max_size=4))
def test_values_match_a_csv_reader(spark, tmp_path_factory, landed):
    folder, want = str(tmp_path_factory.mktemp("csv")), []
    for i, (names, width, values) in enumerate(landed):
        text = io.StringIO()
        csv.writer(text, lineterminator="\n").writerows([names[:width], values[:width]])
        put(folder, f"{i}.csv", text.getvalue())
        row = dict(zip(names[:width], values))
        want.append(tuple(row.get(c) for c in ("a", "d e", "zz")))
    got = headers.scan_csv_by_name(spark, folder, ["a", "d e", "zz"]).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:3]) for r in got)


SCHEMA = "a int, s struct<x: string, y: string>, l array<struct<k: string>>"


def land(spark, folder, lines):
    put(folder, "a.json", "\n".join(lines) + "\n")
    return drift.scan_variant(spark, folder)


def test_drift_is_listed_with_counts(spark, tmp_dir):
    rows = land(spark, tmp_dir, [
        '{"a":1,"s":{"x":"t","y":null},"l":[{"k":"v"}]}',
        '{"a":"1","s":{"x":"t","z":{"q":1}},"l":[{"k":3,"n":1}, 5],"new":[1]}',
        '{"a":', '[{"a":2}]', "7", "null", "", '{"a":null,"s":5}', '{"a":1,"a":2}', "{}"])
    got = sorted(map(tuple, drift.drift_report(rows, SCHEMA).collect()), key=str)
    assert got == sorted([
        ("$", "broken", "object", "broken", 2), ("$", "broken", "object", "array", 1), ("$", "broken", "object", "number", 1),
        ("$", "broken", "object", "null", 1), ("a", "retyped", "number", "string", 1), ("s", "retyped", "object", "number", 1),
        ("s.z", "unknown", None, "object", 1), ("new", "unknown", None, "array", 1), ("l.[]", "retyped", "object", "number", 1),
        ("l.[].k", "retyped", "string", "number", 1), ("l.[].n", "unknown", None, "number", 1)], key=str)
    kept = [r[0] for r in rows.select(drift.BROKEN).collect() if r[0] is not None]
    assert sorted(kept) == ['{"a":', '{"a":1,"a":2}']
    assert drift.drift_report(rows.limit(0), SCHEMA).collect() == []


def test_values_equal_the_schema_read(spark, tmp_dir):
    lines = [json.dumps({"a": i, "s": {"x": f"t{i}", "y": None}, "l": [{"k": "v"}] * (i % 3)}) for i in range(30)]
    lines += ["{}", '{"s":null,"a":null}', '{"l":[null]}']
    back = drift.read_fields(land(spark, tmp_dir, lines), SCHEMA).select("a", "s", "l")
    assert sorted(map(str, back.collect())) == sorted(map(str, files.scan_json(spark, tmp_dir, SCHEMA, keep_corrupt=False).collect()))


def test_arrays_become_rows(spark, tmp_dir):
    put(tmp_dir, "a.json", '[{"a":1},{"a":2}]\n[]\n{"a":3}\nx\n[null]\n')
    rows = drift.scan_variant(spark, tmp_dir, arrays=True)
    got = [(r["a"], r[drift.BROKEN]) for r in drift.read_fields(rows, "a int").collect()]
    assert sorted(got, key=str) == sorted([(1, None), (2, None), (3, None), (None, "x"), (None, None)], key=str)


def test_schema_of_all_records(spark, tmp_dir):
    rows = land(spark, tmp_dir, ['{"a":1}', '{"b":"t"}'])
    assert drift.variant_schema(rows).first()[0] == "OBJECT<a: BIGINT, b: STRING>"


def brute(value, kind, path=""):
    """(path, drift, found) of one parsed value against {name: kind}, [kind] or a kind's name."""
    names = {dict: "object", list: "array", str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}
    found, want = names[type(value)], {dict: "object", list: "array"}.get(type(kind), kind)
    if want is None:
        return [(path, "unknown", found)]
    if found != want:
        return [] if found == "null" else [(path, "retyped", found)]
    if found == "object":
        return [x for k, v in value.items() for x in brute(v, kind.get(k), f"{path}.{k}" if path else k)]
    if found == "array":
        return [x for v in value for x in brute(v, kind[0], f"{path}.[]")]
    return []


LEAF = st.one_of(st.none(), st.booleans(), st.integers(0, 3), st.text("ab", max_size=2))
INNER = st.one_of(LEAF, st.dictionaries(st.sampled_from(["x", "y", "k", "z"]), LEAF, max_size=3), st.lists(LEAF, max_size=2),
                  st.lists(st.dictionaries(st.sampled_from(["k", "n"]), LEAF, max_size=2), max_size=2))


@settings(max_examples=12, **QUICK)
@given(st.lists(st.dictionaries(st.sampled_from(["a", "s", "l", "new"]), INNER, max_size=4), min_size=1, max_size=5))
def test_drift_matches_brute_force(spark, tmp_path_factory, records):
    kind = {"a": "number", "s": {"x": "string", "y": "string"}, "l": [{"k": "string"}]}
    want = sorted(x for r in records for x in brute(r, kind))
    rows = land(spark, str(tmp_path_factory.mktemp("json")), [json.dumps(r) for r in records])
    got = sorted((r["path"], r["drift"], r["found"]) for r in drift.drift_report(rows, SCHEMA).collect() for _ in range(r["n"]))
    assert got == want
