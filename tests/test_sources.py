import json
import os

import pytest

from pyspark.sql.types import StructType

from strata.sources import files
from strata.sources.workbook import read_sheet, scan_workbooks, workbook_bytes, write_workbooks


def test_csv_keeps_malformed_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    with open(p, "w") as f:
        f.write('id,name\n1,x\n2,"unterminated\n')
    df = files.scan_csv(spark, p, files.all_string_schema(["id", "name"]))
    rows = df.collect()
    assert rows[0]["id"] == "1" and rows[0]["_corrupt_record"] is None
    assert len(rows) == 2


def test_multiline_json_array_with_explicit_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.json")
    with open(p, "w") as f:
        json.dump([{"id": "a", "s": {"x": "1"}, "arr": []}, {"id": "b", "s": None, "arr": None}],
                  f, indent=2)
    schema = StructType.fromDDL("id string, s struct<x: string>, arr array<string>")
    df = files.scan_json(spark, p, schema, multiline=True)
    got = {r["id"]: (r["s"], r["arr"]) for r in df.collect()}
    assert got["a"][1] == [] and got["b"] == (None, None)


def test_audit_columns_name_each_file(spark, tmp_dir):
    for n in ("one", "two"):
        with open(os.path.join(tmp_dir, f"{n}.csv"), "w") as f:
            f.write("id\n1\n")
    df = files.with_audit(files.scan_csv(spark, tmp_dir, files.all_string_schema(["id"])))
    assert sorted(r["_source_file"] for r in df.collect()) == ["one.csv", "two.csv"]
    assert df.filter("_ingested_at IS NULL").count() == 0


def test_landing_missing_and_require(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("id\n1\n")
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    miss = sorted(r["name"] for r in files.landing_missing(
        spark, tmp_dir, ["a.csv", "b.csv", "empty.csv"]).collect())
    assert miss == ["b.csv"]
    files.require_landing(spark, tmp_dir, ["a.csv"])
    with pytest.raises(FileNotFoundError, match=r"\['b.csv'\]"):
        files.require_landing(spark, tmp_dir, ["a.csv", "b.csv"])
    with pytest.raises(ValueError, match="empty in .*empty.csv"):
        files.require_landing(spark, tmp_dir, ["a.csv", "empty.csv"])


def test_reordered_header_is_refused(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        files.scan_csv(spark, tmp_dir, files.all_string_schema(["a", "b"])).collect()


def test_broken_lines_and_json_keep_their_text(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("a,b\n1,2\n3\n4,5,6\n")
    rows = files.scan_csv(spark, os.path.join(tmp_dir, "a.csv"), files.all_string_schema(["a", "b"])).collect()
    assert [r[files.CORRUPT] for r in rows] == [None, "3", "4,5,6"]
    with open(os.path.join(tmp_dir, "c.json"), "w") as f:
        f.write('[{"x": "1"}, {"x": ')
    rows = files.scan_json(spark, os.path.join(tmp_dir, "c.json"), "x string", multiline=True).collect()
    assert any(r[files.CORRUPT] is not None for r in rows)


def test_published_tables_switch_together(spark, tmp_dir):
    files.publish(spark, tmp_dir, "r1", {"silver.a": "/1/a", "silver.b": "/1/b"})
    files.publish(spark, tmp_dir, "r2", {"gold.g": "/2/g"})
    files.publish(spark, tmp_dir, "r3", {"silver.a": "/3/a", "silver.b": "/3/b"})
    assert files.published(spark, tmp_dir) == {"silver.a": "/3/a", "silver.b": "/3/b", "gold.g": "/2/g"}


def test_source_names_survive(spark, tmp_dir):
    names = ["sign up", "a/b:c", "x=y%20", "é", None, "12", "007"]
    p = os.path.join(tmp_dir, "s")
    files.write_table(spark.createDataFrame(list(enumerate(names)), "id int, src string"), p, partition_by=["src"])
    got = files.union_sources(spark, p, source_column="src").collect()
    assert {r["id"]: r["_source"] for r in got} == dict(enumerate(names))


def test_overwrite_twice_leaves_one_copy(spark, tmp_dir):
    df = spark.range(5)
    p = os.path.join(tmp_dir, "t")
    files.write_table(df, p)
    files.write_table(df, p)
    assert files.read_table(spark, p).count() == 5


def test_table_counts_and_missing_sources(spark, tmp_dir):
    out = {r["table_name"]: (r["n"], r["status"]) for r in files.table_counts(
        {"a": spark.range(3), "b": spark.range(0), "c": None}).collect()}
    assert out == {"a": (3, "OK"), "b": (0, "EMPTY"), "c": (None, "MISSING")}
    p = os.path.join(tmp_dir, "u")
    files.write_table(spark.createDataFrame([(1, "GB"), (2, "US")], "id int, cc string"), p,
                      partition_by=["cc"])
    u = files.union_sources(spark, p, source_column="cc")
    assert sorted(r["_source"] for r in u.collect()) == ["GB", "US"]
    assert [r["_source"] for r in files.missing_sources(u, ["GB", "US", "IN"]).collect()] == ["IN"]


def test_workbook_round_trip_and_shared_strings(spark, tmp_dir):
    rows = read_sheet(workbook_bytes("s", ["a", "b"], [["x", 1.0], [None, 2.5], ["y", True]]))
    assert rows == [["a", "b"], ["x", "1"], [None, "2.5"], ["y", "TRUE"]]
    df = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "id int, name string")
    p = os.path.join(tmp_dir, "wb")
    assert write_workbooks(df.repartition(3), p, "sheet1") == 3
    back = scan_workbooks(spark, p, ["name", "id"], sheet="sheet1")
    assert sorted((r["id"], r["name"]) for r in back.collect()) == [
        (str(i), f"n{i}") for i in range(7)]


def test_workbook_reader_handles_shared_string_table(tmp_dir):
    import io
    import zipfile
    buf = io.BytesIO(workbook_bytes("s", ["h"], [["v"]]))
    src = zipfile.ZipFile(buf)
    out = io.BytesIO()
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(out, "w") as z:
        for n in src.namelist():
            if n != "xl/worksheets/sheet1.xml":
                z.writestr(n, src.read(n))
        z.writestr("xl/sharedStrings.xml",
                   f'<sst xmlns="{ns}"><si><t>head</t></si><si><r><t>pa</t></r><r><t>rt</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row>'
                   '<row r="2"><c r="B2" t="s"><v>1</v></c></row></sheetData></worksheet>')
    assert read_sheet(out.getvalue()) == [["head"], [None, "part"]]


def test_workbook_start_cell(spark, tmp_dir):
    p = os.path.join(tmp_dir, "w.xlsx")
    with open(p, "wb") as f:
        f.write(workbook_bytes("s", ["title", None], [[None, None], [None, "id"], [None, "7"]]))
    back = scan_workbooks(spark, p, ["id"], sheet="s", start_cell="B3")
    assert [r["id"] for r in back.collect()] == ["7"]


def test_verify_tables_reports_failed(spark, tmp_dir):
    ok = os.path.join(tmp_dir, "ok")
    files.write_table(spark.range(2), ok)
    out = {r["table_name"]: r["status"] for r in files.verify_tables(
        spark, {"ok": ok, "gone": os.path.join(tmp_dir, "nope")}).collect()}
    assert out == {"ok": "OK", "gone": "FAILED"}
    try:
        files.verify_tables(spark, {"gone": os.path.join(tmp_dir, "nope")}, require=True)
    except RuntimeError as e:
        assert "gone" in str(e)
    else:
        raise AssertionError("expected RuntimeError")
