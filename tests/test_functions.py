import datetime as dt

from pyspark.sql import functions as F

from strata import functions as S


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_parse_date_tries_formats_in_order(spark):
    df = spark.createDataFrame([("2026-01-05",), ("05-01-2026",), ("2026-13-01",), (None,),
                                (" 2026-02-03 ",)], "t string")
    got = [r["d"] for r in df.select(S.parse_date("t").alias("d")).collect()]
    assert got == [dt.date(2026, 1, 5), dt.date(2026, 1, 5), None, None, dt.date(2026, 2, 3)]


def test_safe_int_handles_spreadsheet_floats(spark):
    df = spark.createDataFrame([("12",), ("12.0",), (" 85000.0 ",), ("x1",), (None,)], "t string")
    got = [r["i"] for r in df.select(S.safe_int("t").alias("i")).collect()]
    assert got == [12, 12, 85000, None, None]


def test_text_to_bool(spark):
    df = spark.createDataFrame([("TRUE",), (" true ",), ("FALSE",), ("yes",), (None,)], "t string")
    got = [r["b"] for r in df.select(S.text_to_bool("t").alias("b")).collect()]
    assert got == [True, True, False, False, False]


def test_blank_to_null_and_trim_keeps_tabs(spark):
    df = spark.createDataFrame([("  ",), ("",), (" a ",), ("\ta ",)], "t string")
    got = [r["x"] for r in df.select(S.blank_to_null("t").alias("x")).collect()]
    assert got == [None, None, "a", "\ta"]


def test_in_domain_is_null_safe(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "t string")
    got = [r["x"] for r in df.select(S.in_domain("t", ["A"]).alias("x")).collect()]
    assert got == [True, False, False]


def test_hash_null_tokens_prevent_shifts(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    h = [r["h"] for r in df.select(S.md5_of(["x", "y"]).alias("h")).collect()]
    assert h[0] != h[1]
    plain = [r["h"] for r in df.select(F.md5(F.concat_ws("||", "x", "y")).alias("h")).collect()]
    assert plain[0] == plain[1]       # why the tokens are needed


def test_surrogate_key_matches_md5_of_text(spark):
    v = _one(spark, S.md5_of(["k", "d"]), "k string, d date", ("EMP001", dt.date(2025, 4, 21)))
    import hashlib
    assert v == hashlib.md5(b"EMP001||2025-04-21").hexdigest()


def test_keyed_value_first_match_empty_and_null(spark):
    schema = "a array<struct<key:string,value:string>>"
    df = spark.createDataFrame([([("k", "1"), ("k", "2")],), ([],), (None,), ([("z", "9")],)],
                               schema)
    got = [r["v"] for r in df.select(S.keyed_value("a", "k").alias("v")).collect()]
    assert got == ["1", None, None, None]


def test_first_element_on_empty_array(spark):
    df = spark.createDataFrame([(["x", "y"],), ([],), (None,)], "a array<string>")
    got = [r["v"] for r in df.select(S.first_element("a").alias("v")).collect()]
    assert got == ["x", None, None]


def test_ascending_is_empty_when_reversed(spark):
    df = spark.createDataFrame([(3, 5), (5, 3)], "a int, b int")
    got = [r["s"] for r in df.select(S.ascending(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [[3, 4, 5], []]


def test_no_digit(spark):
    df = spark.createDataFrame([("call reception",), ("+1 555",), (None,)], "t string")
    got = [r["x"] for r in df.select(S.no_digit("t").alias("x")).collect()]
    assert got == [True, False, None]


def test_hashes_of_different_values_differ(spark):
    from strata.functions import md5_of
    rows = [("NULL", "x"), (None, "x"), ("a||b", "c"), ("a", "b||c"), ("a|", "|b"), ("a||", "b"), ("\\NULL", "x"),
            ("a\\", "b"), ("a", "\\b")]
    got = spark.createDataFrame(rows, "a string, b string").select(md5_of(["a", "b"]).alias("h")).collect()
    assert len({r["h"] for r in got}) == len(rows)
