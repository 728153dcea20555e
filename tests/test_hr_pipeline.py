import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.gates import QualityError
from strata.operators.history import SENTINEL
from strata.plans import hr
from strata.sources.files import read_table
from tests.fixtures import write_landing

D = dt.date


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("hr")
    landing = write_landing(str(root / "landing"))
    paths = hr.run(spark, landing, str(root / "warehouse"))
    paths.update(hr.gold(spark, paths, str(root / "warehouse")))
    return {k: read_table(spark, p) for k, p in paths.items()}


def test_bronze_keeps_raw_text_and_audit(built):
    dep = built["bronze.departments"]
    assert "D1 " in [r["department_id"] for r in dep.collect()]      # untrimmed in Bronze
    assert {r["_source_file"] for r in dep.collect()} == {"departments.csv"}
    ev = built["bronze.employee_events"]
    assert dict(ev.dtypes)["salary"] == "string"
    emp = built["bronze.employees"].collect()
    assert {r["salary"] for r in emp} == {"120", "99", "95", "130"}
    assert len(emp) == 4


def test_silver_reference_and_events(built):
    dep = {r["department_id"]: r for r in built["silver.departments"].collect()}
    assert set(dep) == {"D1", "D2", "D3"} and dep["D2"]["department_name"] == "Sales"
    ev = {r["event_id"]: r for r in built["silver.employee_events"].collect()}
    assert ev["V03"]["event_type"] == "HIRE"
    assert ev["V03"]["event_date"] == D(2026, 1, 5)
    assert ev["V01"]["manager_employee_id"] is None and ev["V01"]["salary"] == 100


def test_scd2_history(built):
    h = built["silver.employees_scd2"]
    rows = {(r["employee_id"], r["valid_from"]): r for r in h.collect()}
    assert len(rows) == 8
    assert rows[("P1", D(2025, 11, 3))]["valid_to"] == D(2026, 1, 31)
    assert rows[("P1", D(2026, 6, 1))]["valid_to"] == SENTINEL
    assert rows[("P3", D(2026, 1, 5))]["valid_to"] == D(2026, 4, 30)    # resignation day
    assert not rows[("P3", D(2026, 1, 5))]["is_current"]
    assert rows[("P2", D(2026, 1, 12))]["email"] == "bo@example.test"   # trimmed roster
    assert h.filter("is_current").count() == 3
    assert h.select("employee_sk").distinct().count() == 8


def test_contacts_flat_one_row_per_employee(built):
    c = {r["employee_id"]: r for r in built["silver.employee_contact_info"].collect()}
    assert len(c) == 4
    assert c["P2"]["mobile_phone"] is None and c["P2"]["mobile_phone_invalid"]
    assert c["P3"]["mobile_phone"] is None and not c["P3"]["mobile_phone_invalid"]
    assert c["P2"]["ec_full_name"] is None                    # NULL struct
    assert c["P3"]["work_email"] is None
    assert c["P1"]["pref_timezone"] == "UTC"                  # first key wins
    assert c["P3"]["pref_language"] is None and c["P4"]["pref_language"] is None
    assert "preferences" not in c["P1"].asDict()
    assert c["P1"]["last_updated_ts"].isoformat().startswith("2026-06-01T10:00:00")


def test_contact_quarantine_keeps_raw_value(built):
    q = built["silver.employee_contact_info_quarantine"].collect()
    assert [(r["employee_id"], r["mobile_phone"], list(r["_violations"])) for r in q] == [
        ("P2", "call reception", ["mobile_phone_no_digit"])]


def test_holidays_shaped_to_window(built):
    h = {r["holiday_name"]: r for r in built["silver.public_holidays"].collect()}
    assert set(h) == {"New Year's Day", "Spring Bank Holiday", "Local Day"}
    assert h["Spring Bank Holiday"]["holiday_type"] == "Public"
    assert h["Local Day"]["holiday_type"] is None


def test_missing_landing_file_raises(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"))
    os.remove(os.path.join(landing, "employees.xlsx"))
    with pytest.raises(FileNotFoundError, match="employees.xlsx"):
        hr.run(spark, landing, str(tmp_path / "wh"))


def test_unknown_event_type_fails_the_gate(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"))
    good = hr.run(spark, landing, str(tmp_path / "wh"))
    before = read_table(spark, good["silver.employee_events"]).count()
    with open(os.path.join(landing, "employee_events.csv"), "a") as f:
        f.write("V10,P4,PROMOTED,2026-05-01,D2,J3,,140,\n")
    with pytest.raises(QualityError, match="unknown_type"):
        hr.run(spark, landing, str(tmp_path / "wh"))
    # the failed run never replaced the published Silver table
    assert read_table(spark, good["silver.employee_events"]).count() == before


def test_same_day_events_fail_history_gate(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"))
    with open(os.path.join(landing, "employee_events.csv"), "a") as f:
        f.write("V10,P4,PROMOTION,2026-02-20,D2,J3,,140,\n")
    with pytest.raises(QualityError, match="inverted"):
        hr.run(spark, landing, str(tmp_path / "wh"))
    paths = hr.run(spark, landing, str(tmp_path / "wh2"), same_day="last")
    h = read_table(spark, paths["silver.employees_scd2"]).filter(F.col("employee_id") == "P4")
    assert [r["salary"] for r in h.collect()] == [140]


def test_gold_headcount_at_month_ends(built):
    snap = built["gold.fact_headcount_snapshot"]
    per_month = {r["month_end"]: r["n"] for r in
                 snap.groupBy("month_end").agg(F.sum("headcount").alias("n")).collect()}
    assert [per_month[D(2026, m, d)] for m, d in
            ((1, 31), (2, 28), (3, 31), (4, 30), (5, 31), (6, 30))] == [3, 4, 4, 4, 3, 3]


def test_gold_facts_join_the_version_alive_that_day(built):
    obt = {r["event_id"]: r for r in built["gold.obt"].collect()}
    assert len(obt) == 9
    assert obt["V07"]["department_name"] == "People"          # exit day still in version
    assert obt["V09"]["department_name"] == "Sales" and obt["V09"]["salary"] == 120
    assert all(r["employee_sk"] is not None for r in obt.values())
    assert built["gold.fact_employee_events"].count() == 9
    dim = built["gold.dim_employee"]
    assert dim.count() == 8 and dim.filter("job_title IS NULL").count() == 0
    dd = built["gold.dim_date"]
    assert dd.count() == 181 and dd.filter("is_public_holiday").count() == 2


def test_per_country_holiday_files_and_missing_country(spark, tmp_path):
    import json
    from tests.fixtures import HOLIDAYS
    landing = write_landing(str(tmp_path / "landing"))
    os.remove(os.path.join(landing, "public_holidays.json"))
    with pytest.raises(FileNotFoundError, match="public_holidays.json"):
        hr.run(spark, landing, str(tmp_path / "wh"))
    for cc in ("GB", "US", "IN"):
        with open(os.path.join(landing, f"public_holidays_{cc}.json"), "w") as f:
            json.dump([h for h in HOLIDAYS if h["countryCode"] == cc], f, indent=2)
    paths = hr.run(spark, landing, str(tmp_path / "wh"), holiday_countries=["GB", "US", "IN"],
                   calendar_hi=D(2026, 12, 31))
    bronze = read_table(spark, paths["bronze.public_holidays"])
    assert bronze.count() == 4
    assert bronze.select("_source_file").distinct().count() == 3
    assert read_table(spark, paths["silver.public_holidays"]).count() == 4   # the window is a parameter
    with pytest.raises(QualityError, match="missing_holiday_country.FR"):
        hr.run(spark, landing, str(tmp_path / "wh2"), holiday_countries=["GB", "FR"])
    with open(os.path.join(landing, "public_holidays.json"), "w") as f:
        json.dump(HOLIDAYS, f)
    with pytest.raises(ValueError, match="count twice"):
        hr.run(spark, landing, str(tmp_path / "wh3"))


def _append(name, line):
    def change(landing):
        with open(os.path.join(landing, name), "a") as f:
            f.write(line)
    return change


def _edit(name, old, new):
    def change(landing):
        p = os.path.join(landing, name)
        with open(p) as f:
            text = f.read()
        assert old in text
        with open(p, "w") as f:
            f.write(text.replace(old, new, 1))
    return change


def _truncate(name):
    def change(landing):
        p = os.path.join(landing, name)
        with open(p) as f:
            text = f.read()
        with open(p, "w") as f:
            f.write(text[:len(text) * 2 // 3])
    return change


def _roster(change_rows):
    def change(landing):
        from strata.sources.workbook import workbook_bytes
        from tests.fixtures import EMPLOYEES, EMPLOYEES_HEADER
        with open(os.path.join(landing, "employees.xlsx"), "wb") as f:
            f.write(workbook_bytes("employees", EMPLOYEES_HEADER, change_rows([list(r) for r in EMPLOYEES])))
    return change


@pytest.mark.parametrize("change,names", [
    (_truncate("employee_contact_info.json"), ["employee_contact_info.corrupt_record"]),
    (_append("employee_events.csv", "V10,P4,TRANSFER,2026-05-01\n"), ["employee_events.corrupt_record=1"]),
    (_append("employee_events.csv", "V10,P4,TRANSFER,2026-05-01,D2,J3,,13O,\n"), ["employee_events.bad_salary=1"]),
    (_append("employee_events.csv", "V10,P4,X1,2026-05-01,D2,J3,,1,\nV11,P4,X2,2026-06-01,D2,J3,,1,\nV11,,HIRE,2026-06-02,,,,1,\n"),
     ["employee_events.unknown_type=2", "employee_events.duplicate_keys=1", "employee_events.null_employee=1"]),
    (_append("employee_events.csv", "V10,P4,TRANSFER,2026/05/01,D2,J3,,1,\nV11,P4,TRANSFER,soon,D2,J3,,1,\n"),
     ["employee_events.bad_event_date=2"]),
    (_edit("public_holidays.json", "2026-05-25", "2026/05/25"), ["public_holidays.bad_date=1"]),
    (_edit("employee_contact_info.json", '"employee_id": "P1"', '"employee_id": null'), ["employee_contact_info.null_keys=1"]),
    (_edit("employee_contact_info.json", '"employee_id": "P1"', '"employee_id": "P2"'), ["employee_contact_info.duplicate_keys=1"]),
    (_roster(lambda rows: [[None, *rows[0][1:]], *rows[1:]]), ["employees.null_keys=1"]),
    (_roster(lambda rows: [*rows, rows[0]]), ["employees.duplicate_keys=1"]),
])
def test_malformed_landing_files_fail_by_name(spark, tmp_path, change, names):
    from strata.sources.files import published
    landing, wh = write_landing(str(tmp_path / "landing")), str(tmp_path / "wh")
    change(landing)
    with pytest.raises(QualityError) as e:
        hr.run(spark, landing, wh)
    assert all(n in str(e.value) for n in names), str(e.value)
    assert not os.path.exists(os.path.join(wh, "_published"))


def test_reordered_header_fails_the_run(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"))
    _edit("departments.csv", "department_id,department_name,cost_center", "cost_center,department_name,department_id")(landing)
    with pytest.raises(Exception, match="header"):
        hr.run(spark, landing, str(tmp_path / "wh"))


def test_failed_run_leaves_the_published_run_readable(spark, tmp_path, monkeypatch):
    from strata.sources.files import published
    landing, wh = write_landing(str(tmp_path / "landing")), str(tmp_path / "wh")
    good = hr.run(spark, landing, wh)
    assert published(spark, wh) == good
    steps = {"n": 0}
    write = hr.write_table

    def crash(df, path, *a, **k):
        steps["n"] += 1
        if steps["n"] == steps["at"]:
            raise OSError("disk gone")
        return write(df, path, *a, **k)

    monkeypatch.setattr(hr, "write_table", crash)
    for at in (2, 8, 12):
        steps |= {"n": 0, "at": at}
        with pytest.raises(OSError):
            hr.run(spark, landing, wh)
        assert published(spark, wh) == good
        assert read_table(spark, good["silver.employees_scd2"]).count() == 8


def test_command_line_hr_with_gold(spark, tmp_path, capsys):
    import json
    from strata.__main__ import main
    landing = write_landing(str(tmp_path / "landing"))
    main(["hr", "--landing", landing, "--warehouse", str(tmp_path / "wh"), "--gold",
          "--holiday-countries", "GB,US"])
    paths = json.loads(capsys.readouterr().out)
    assert {"silver.employees_scd2", "gold.obt", "gold.dim_date"} <= set(paths)
    assert read_table(spark, paths["gold.obt"]).count() == 9
