"""The people-analytics pipeline on reference-shaped landing files.

Landing (CSV, workbook, JSON) -> Bronze (raw text + audit columns) -> Silver
(trimmed, typed, gated; SCD2 history; flat contacts; holiday calendar).

Each ``silver_*`` builder is lazy and pure; :func:`run` executes the layers in
order, writing each table once and gating the *written* table (one fused
aggregate per table), so no gate re-runs the upstream lineage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import in_domain, no_digit, not_in_domain, parse_date, safe_int
from strata.functions.columns import blank_to_null, parse_timestamp
from strata.operators import calendar, clean as cleaning, gates, marts, nested
from strata.operators.history import scd2
from strata.operators.keys import with_keys
from strata.sources.files import (CORRUPT, all_string_schema, landed_files, missing_sources,
                                  publish, read_table, require_landing, scan_csv, scan_json,
                                  verify_tables, with_audit, write_table)
from strata.sources.workbook import scan_workbooks

# ---------------------------------------------------------------- fixed values
# Landed file names, raw column lists, the event vocabulary and the calendar window.
LANDING_FILES = ("departments.csv", "job_roles.csv", "employee_events.csv",
                 "employees.xlsx", "employee_contact_info.json")
HOLIDAY_FILE, HOLIDAY_FILES_BY_COUNTRY = "public_holidays.json", "public_holidays_*.json"
DEPARTMENT_COLUMNS = ("department_id", "department_name", "cost_center")
JOB_ROLE_COLUMNS = ("job_role_id", "job_title", "job_level")
EVENT_COLUMNS = ("event_id", "employee_id", "event_type", "event_date", "department_id",
                 "job_role_id", "manager_employee_id", "salary", "notes")
EMPLOYEE_COLUMNS = ("employee_id", "first_name", "last_name", "email", "hire_date",
                    "termination_date", "department_id", "job_role_id",
                    "manager_employee_id", "salary", "is_active")
EVENT_TYPES = ("HIRE", "PROMOTION", "TRANSFER", "SALARY_CHANGE", "RESIGNATION", "TERMINATION")
EXIT_TYPES = ("RESIGNATION", "TERMINATION")
START_TYPE = "HIRE"
TRACKED = ("department_id", "job_role_id", "manager_employee_id", "salary")
CALENDAR_LO, CALENDAR_HI = dt.date(2026, 1, 1), dt.date(2026, 6, 30)
CONTACT_SCHEMA = (
    "employee_id string, "
    "contact struct<phone: struct<mobile: string, work: string, home: string>, "
    "email: struct<personal: string, work: string>>, "
    "address struct<line1: string, line2: string, city: string, state_or_province: string, "
    "postal_code: string, country_code: string>, "
    "emergency_contact struct<full_name: string, relationship: string, "
    "contact: struct<phone: string, email: string>>, "
    "preferences array<struct<key: string, value: string>>, "
    "metadata struct<source_system: string, last_updated: string, schema_version: string>")
HOLIDAY_SCHEMA = (
    "date string, localName string, name string, countryCode string, fixed boolean, "
    "global boolean, counties array<string>, launchYear bigint, types array<string>")
CONTACT_PATHS = {
    "contact.phone.mobile": "mobile_phone", "contact.phone.work": "work_phone",
    "contact.phone.home": "home_phone", "contact.email.personal": "personal_email",
    "contact.email.work": "work_email", "address.line1": "address_line1",
    "address.line2": "address_line2", "address.city": "city",
    "address.state_or_province": "state_or_province", "address.postal_code": "postal_code",
    "address.country_code": "country_code", "emergency_contact.full_name": "ec_full_name",
    "emergency_contact.relationship": "ec_relationship",
    "emergency_contact.contact.phone": "ec_phone", "emergency_contact.contact.email": "ec_email",
    "metadata.source_system": "source_system", "metadata.last_updated": "last_updated",
}
CONTACT_TIMESTAMP = ("last_updated", "last_updated_ts")
PREFERENCES = {"notification_channel": "pref_notification_channel",
               "preferred_language": "pref_language", "timezone": "pref_timezone"}
AUDIT = ("_source_file", "_ingested_at", "_corrupt_record")


# ---------------------------------------------------------------- bronze

def bronze_tables(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """Raw tables: every flat column as text, nested JSON kept nested, + audit."""
    base = landing.rstrip("/")
    return {
        "departments": with_audit(scan_csv(spark, f"{base}/departments.csv",
                                           all_string_schema(DEPARTMENT_COLUMNS))),
        "job_roles": with_audit(scan_csv(spark, f"{base}/job_roles.csv",
                                         all_string_schema(JOB_ROLE_COLUMNS))),
        "employee_events": with_audit(scan_csv(spark, f"{base}/employee_events.csv",
                                               all_string_schema(EVENT_COLUMNS))),
        "employees": scan_workbooks(spark, f"{base}/employees.xlsx", EMPLOYEE_COLUMNS,
                                    sheet="employees", start_cell="A1").withColumn(
                                        "_ingested_at", F.current_timestamp()),
        "employee_contact_info": with_audit(scan_json(
            spark, f"{base}/employee_contact_info.json", CONTACT_SCHEMA, multiline=True)),
        # one file, or one file per country (public_holidays_GB.json ...): one scan;
        # both at once are refused by require_holidays
        "public_holidays": with_audit(scan_json(
            spark, f"{base}/public_holidays*.json", HOLIDAY_SCHEMA, multiline=True)),
    }


# ---------------------------------------------------------------- silver

def silver_reference(df: DataFrame) -> DataFrame:
    return cleaning.trim_strings(df.drop(*[c for c in AUDIT if c in df.columns])).withColumn(
        "_silver_processed_at", F.current_timestamp())


def silver_events(bronze_events: DataFrame) -> DataFrame:
    """Trim, upper-case the type, blanks to NULL, parse the day, salary to int."""
    df = bronze_events.drop(*[c for c in AUDIT if c in bronze_events.columns])
    out = cleaning.clean(df, dates={"event_date": "event_date"}, ints=["salary"],
                         upper=["event_type"],
                         blanks=["department_id", "job_role_id", "manager_employee_id",
                                 "notes"])
    return out.withColumn("_silver_processed_at", F.current_timestamp())


def cast_rules(dates: Sequence[str] = (), ints: Sequence[str] = ()) -> dict[str, Column]:
    """Rules over a Bronze table: text that is there but does not parse to its type."""
    rules: dict[str, Column] = {}
    for c in dates:
        rules[f"bad_{c}"] = blank_to_null(c).isNotNull() & parse_date(c).isNull()
    for c in ints:
        rules[f"bad_{c}"] = blank_to_null(c).isNotNull() & safe_int(c).isNull()
    return rules


def bronze_rules(name: str) -> dict[str, Column]:
    """The rules of one Bronze table, all counted in one pass over the written table."""
    rules = {} if name == "employees" else {"corrupt_record": F.col(CORRUPT).isNotNull()}
    if name == "employee_events":
        rules |= cast_rules(dates=["event_date"], ints=["salary"])
    elif name == "employees":
        rules |= cast_rules(dates=["hire_date", "termination_date"], ints=["salary"])
    elif name == "public_holidays":
        rules["bad_date"] = calendar.unparsed_days()
    return rules


def event_gates(events: DataFrame) -> dict[str, int]:
    """Broken rules of the Silver events with their true counts, in two jobs: one for the
    keys and the row rules, one for the start rule, which needs each entity's events."""
    rows = gates.profile(events, {
        "null_employee": F.col("employee_id").isNull(), "null_date": F.col("event_date").isNull(),
        "unknown_type": not_in_domain("event_type", EVENT_TYPES)}, key="event_id")
    bad = gates.failures(rows, prefix="employee_events.")
    starts = gates.start_violations(events, "employee_id", "event_type",
                                    ["event_date", "event_id"], START_TYPE).count()
    return {**bad, **({"employee_events.start": starts} if starts else {})}


def silver_roster(bronze_employees: DataFrame) -> DataFrame:
    df = bronze_employees.drop(*[c for c in AUDIT if c in bronze_employees.columns])
    return cleaning.clean(df, dates={"hire_date": "hire_date",
                                     "termination_date": "termination_date"},
                          ints=["salary"], bools=["is_active"],
                          blanks=["manager_employee_id", "termination_date"])


def silver_history(events: DataFrame, roster: DataFrame, rehire: bool = False,
                   same_day: str = "fail") -> DataFrame:
    """SCD2 versions of each employee with keys, hashes and roster attributes."""
    versions = scd2(events, key="employee_id", date="event_date", order="event_id",
                    state=TRACKED, is_exit=in_domain("event_type", EXIT_TYPES),
                    same_day=same_day, rehire=rehire)
    keyed = with_keys(versions, "employee_id", TRACKED, sk="employee_sk")
    attrs = roster.select("employee_id", "first_name", "last_name", "email", "hire_date")
    return (keyed.join(attrs, "employee_id", "left")
            .select("employee_sk", "employee_id", "first_name", "last_name", "email",
                    "hire_date", *TRACKED, "valid_from", "valid_to", "is_current", "row_hash")
            .withColumn("_silver_processed_at", F.current_timestamp()))


def history_gates(history: DataFrame, rehire: bool = False) -> dict[str, int]:
    """Invariant breaks of the written history: inverted or overlapping intervals,
    keys with more than one current version, duplicate surrogate keys, and gaps
    unless rehires are allowed. Returns only the non-zero ones."""
    row = gates.history_violations(history, "employee_id").first().asDict()
    if rehire:
        row.pop("gaps")
    row["duplicate_sk"] = gates.duplicate_keys(history, "employee_sk").count()
    return {k: int(v) for k, v in row.items() if v}


def silver_contacts(bronze_contacts: DataFrame) -> DataFrame:
    flat = nested.flatten(bronze_contacts, CONTACT_PATHS, keep=["employee_id", "preferences"])
    flagged = nested.flag_null(flat, "mobile_phone", no_digit("mobile_phone"),
                               "mobile_phone_invalid")
    text, stamp = CONTACT_TIMESTAMP
    return (nested.lookup(flagged, "preferences", PREFERENCES)
            .withColumn(stamp, parse_timestamp(text))
            .withColumn("_silver_processed_at", F.current_timestamp()))


def contact_quarantine(bronze_contacts: DataFrame) -> DataFrame:
    """Contacts with a malformed value, raw values kept, with the broken rules
    (``_violations``); the Silver table carries the same rows flagged and nulled."""
    flat = nested.flatten(bronze_contacts, CONTACT_PATHS, keep=["employee_id"])
    present = F.col("mobile_phone").isNotNull()
    _, bad = gates.split_quarantine(flat, {"mobile_phone_no_digit":
                                           present & no_digit("mobile_phone")})
    return bad.withColumn("_quarantined_at", F.current_timestamp())


def silver_holidays(bronze_holidays: DataFrame, lo: dt.date = CALENDAR_LO,
                    hi: dt.date = CALENDAR_HI) -> DataFrame:
    return calendar.shape_calendar(bronze_holidays, lo, hi).withColumn(
        "_silver_processed_at", F.current_timestamp())


# ---------------------------------------------------------------- run

def _raise(bad: dict[str, int]) -> None:
    if bad:
        raise gates.QualityError(bad)


def require_holidays(spark: SparkSession, landing: str) -> None:
    """Holidays land as one file or as one file per country: neither is missing, and both
    together, which would count every day twice, are refused."""
    whole = landed_files(spark, landing, HOLIDAY_FILE).count()
    parts = landed_files(spark, landing, HOLIDAY_FILES_BY_COUNTRY).count()
    if not whole and not parts:
        raise FileNotFoundError(f"missing in {landing}: ['{HOLIDAY_FILE}']")
    if whole and parts:
        raise ValueError(f"{landing} holds {HOLIDAY_FILE} and {HOLIDAY_FILES_BY_COUNTRY}: "
                         "holidays would count twice")


def run(spark: SparkSession, landing: str, warehouse: str, rehire: bool = False,
        same_day: str = "fail", holiday_countries: Sequence[str] = (),
        calendar_lo: dt.date = CALENDAR_LO, calendar_hi: dt.date = CALENDAR_HI) -> dict[str, str]:
    """Landing -> Bronze -> Silver. Returns {table: path}. Raises on any gate.

    ``holiday_countries``: countries whose holidays must be present; an absent
    one fails the run by name instead of silently leaving the calendar short.
    ``calendar_lo`` / ``calendar_hi``: the days kept in the holiday calendar.

    Every table is written once, into the folder of this run, and gated as written, so
    no gate runs the lineage again. All broken rules of a layer are raised together with
    their counts. The tables are published together at the end; a run that fails before
    leaves the published ones as they were (:func:`strata.sources.files.published`).
    """
    import uuid
    require_landing(spark, landing, LANDING_FILES)
    require_holidays(spark, landing)
    run_id = uuid.uuid4().hex[:12]
    base = f"{warehouse.rstrip('/')}/_runs/{run_id}"
    paths: dict[str, str] = {}

    def put(layer: str, name: str, df: DataFrame) -> DataFrame:
        paths[f"{layer}.{name}"] = write_table(df, f"{base}/{layer}/{name}")
        return read_table(spark, paths[f"{layer}.{name}"])

    bad: dict[str, int] = {}
    b: dict[str, DataFrame] = {}
    for name, df in bronze_tables(spark, landing).items():
        b[name] = put("bronze", name, df)
        bad |= gates.failures(gates.profile(b[name], bronze_rules(name)), prefix=f"{name}.")
    if holiday_countries:
        for r in missing_sources(b["public_holidays"], holiday_countries, "countryCode").collect():
            bad[f"missing_holiday_country.{r['countryCode']}"] = 1
    _raise(bad)

    for name, key in (("departments", "department_id"), ("job_roles", "job_role_id")):
        df = put("silver", name, silver_reference(b[name]))
        bad |= gates.failures(gates.profile(df, {}, key=key), prefix=f"{name}.")
    ev = put("silver", "employee_events", silver_events(b["employee_events"]))
    bad |= event_gates(ev)
    roster = silver_roster(b["employees"])
    bad |= gates.failures(gates.profile(roster.select("employee_id"), {}, key="employee_id"), prefix="employees.")
    contacts = put("silver", "employee_contact_info", silver_contacts(b["employee_contact_info"]))
    bad |= gates.failures(gates.profile(contacts, {}, key="employee_id"), prefix="employee_contact_info.")
    changed = gates.row_count_check(b["employee_contact_info"], contacts, "employee_id").count()
    if changed:
        bad["employee_contact_info.row_count"] = changed
    put("silver", "employee_contact_info_quarantine",
        contact_quarantine(b["employee_contact_info"]))
    holidays = put("silver", "public_holidays",
                   silver_holidays(b["public_holidays"], calendar_lo, calendar_hi))
    doubled = gates.duplicate_keys(holidays, ["country_code", "holiday_date", "holiday_name"]).count()
    if doubled:
        bad["public_holidays.duplicates"] = doubled
    _raise(bad)

    hist = put("silver", "employees_scd2",
               silver_history(ev, roster, rehire=rehire, same_day=same_day))
    _raise(history_gates(hist, rehire=rehire))
    # an empty quarantine or calendar window may be right, so they need no rows
    verify_tables(spark, {k: v for k, v in paths.items() if k.startswith("silver.")
                          and not k.endswith(("_quarantine", "public_holidays"))}, require=True)
    publish(spark, warehouse, run_id, paths)
    return paths


# ---------------------------------------------------------------- gold

# Default snapshot months and holiday country of the date dimension.
SNAPSHOT_LO, SNAPSHOT_HI = dt.date(2026, 1, 1), dt.date(2026, 6, 30)
HOLIDAY_COUNTRY = "GB"


def gold(spark: SparkSession, silver: dict[str, str], warehouse: str,
         country: str = HOLIDAY_COUNTRY, lo: dt.date = SNAPSHOT_LO,
         hi: dt.date = SNAPSHOT_HI) -> dict[str, str]:
    """Silver -> Gold: dim_employee, dim_date, fact_employee_events (as-of),
    fact_headcount_snapshot and the OBT. Returns {table: path}.

    ``lo`` / ``hi``: the days of the date dimension and the months of the snapshot. The
    version table is read once from Silver (already written, so the history is not
    recomputed); the event facts are shuffled once, by the as-of join against the wide
    employee dimension. As in :func:`run`, tables are written to a folder of their own,
    gated, and published together.
    """
    import uuid
    run_id = uuid.uuid4().hex[:12]
    base = f"{warehouse.rstrip('/')}/_runs/{run_id}/gold"
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[f"gold.{name}"] = write_table(df, f"{base}/{name}")
        return read_table(spark, paths[f"gold.{name}"])

    versions = read_table(spark, silver["silver.employees_scd2"]).drop("_silver_processed_at")
    departments = read_table(spark, silver["silver.departments"]).select(
        "department_id", "department_name", "cost_center")
    roles = read_table(spark, silver["silver.job_roles"]).select(
        "job_role_id", "job_title", "job_level")
    _raise({**gates.failures(gates.profile(departments, {}, key="department_id"), prefix="departments."),
            **gates.failures(gates.profile(roles, {}, key="job_role_id"), prefix="job_roles.")})
    dim_employee = put("dim_employee", marts.enrich(
        marts.enrich(versions, departments, "department_id"), roles, "job_role_id"))

    holidays = read_table(spark, silver["silver.public_holidays"])
    dim_date = put("dim_date", calendar.dim_date(spark, lo, hi, holidays, country))
    put("fact_headcount_snapshot", marts.snapshot(versions, lo, hi, by=["department_id"]))

    events = read_table(spark, silver["silver.employee_events"]).select(
        "event_id", "employee_id", "event_type", "event_date")
    wide = dim_employee.select("employee_id", "valid_from", "valid_to", "employee_sk",
                               "department_name", "job_title", "salary")
    obt = put("obt", marts.asof(events, wide, "employee_id", "event_date", how="left")
              .join(dim_date.select(F.col("date").alias("event_date"), "is_public_holiday",
                                    "is_weekend"), "event_date", "left"))
    put("fact_employee_events", obt.select("event_id", "employee_id", "event_type",
                                           "event_date", "employee_sk"))
    lost = gates.row_count_check(events, obt, "event_id").count()
    _raise({"obt.row_count": lost} if lost else {})
    publish(spark, warehouse, run_id, paths)
    return paths
