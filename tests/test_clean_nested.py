import datetime as dt

from pyspark.sql import functions as F

from strata.functions import no_digit
from strata.operators import clean, nested


def test_clean_types_every_column_in_one_projection(spark):
    df = spark.createDataFrame([(" e1 ", " hire ", "05-01-2026", " 12.0 ", " TRUE ", "  ", "x")],
                               "id string, t string, d string, n string, b string, z string, "
                               "_source_file string")
    out = clean.clean(df, dates={"d": "day"}, ints=["n"], bools=["b"], upper=["t"],
                      blanks=["z"], rename={"id": "event_id"}, drop=["_source_file"])
    assert out.columns == ["event_id", "t", "day", "n", "b", "z"]
    r = out.first()
    assert (r["event_id"], r["t"], r["day"], r["n"], r["b"], r["z"]) == (
        "e1", "HIRE", dt.date(2026, 1, 5), 12, True, None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 2      # one, plus a shared-subexpression project


def test_trim_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(" a ", 1)], "s string, i int")
    out = clean.trim_strings(df)
    assert out.dtypes == [("s", "string"), ("i", "int")] and out.first()["s"] == "a"


def test_flatten_null_struct_gives_null_leaves(spark):
    df = spark.createDataFrame([("a", None), ("b", (("x",),))], "id string, s struct<t: struct<u: string>>")
    got = {r["id"]: r["u"] for r in nested.flatten(df, {"s.t.u": "u"}, keep=["id"]).collect()}
    assert got == {"a": None, "b": "x"}


def test_flag_null_keeps_reason(spark):
    df = spark.createDataFrame([("call reception",), ("+1 2",), (None,)], "p string")
    rows = nested.flag_null(df, "p", no_digit("p"), "p_invalid").collect()
    assert [(r["p"], r["p_invalid"]) for r in rows] == [(None, True), ("+1 2", False),
                                                        (None, False)]


def test_lookup_and_explode_pairs(spark):
    df = spark.createDataFrame([(1, [("a", "1"), ("b", "2"), ("a", "3")]), (2, []), (3, None)],
                               "id int, kv array<struct<key: string, value: string>>")
    lk = {r["id"]: (r["A"], r["B"]) for r in nested.lookup(df, "kv", {"a": "A", "b": "B"}).collect()}
    assert lk == {1: ("1", "2"), 2: (None, None), 3: (None, None)}
    ex = sorted((r["id"], r["key"] or "", r["value"] or "") for r in
                nested.explode_pairs(df, "kv", ["id"]).collect())
    assert ex == [(1, "a", "1"), (1, "a", "3"), (1, "b", "2"), (2, "", ""), (3, "", "")]


def test_nested_profile(spark):
    df = spark.createDataFrame([("a", None, []), ("b", ("x",), ["y"])],
                               "id string, s struct<t: string>, arr array<string>")
    row = nested.nested_profile(df, null_paths=["s", "s.t"], empty_arrays=["arr"]).first()
    assert row.asDict() == {"n_rows": 2, "null_s": 1, "null_s_t": 1, "empty_arr": 1}


def test_first_element_column(spark):
    df = spark.createDataFrame([(["p", "q"],), ([],)], "a array<string>")
    got = [r["f"] for r in nested.first_element(df, "a", "f").collect()]
    assert got == ["p", None]
    assert F  # keep the import used


def test_pivot_pairs_first_by_order(spark):
    df = spark.createDataFrame([(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "system", "s"),
                                (2, 1, "assistant", "x")], "c int, t int, role string, text string")
    got = {r["c"]: (r["u"], r["s"]) for r in
           nested.pivot_pairs(df, "c", "role", "text", "t", {"user": "u", "system": "s"}).collect()}
    assert got == {1: ("a", "s"), 2: (None, None)}
