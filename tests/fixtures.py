"""Reference-shaped landing files written by the tests (our own rows).

Planted cases: a day-first event date, a padded e-mail, a spreadsheet float salary,
a blank manager, a NULL emergency-contact struct, a malformed mobile, a NULL work
e-mail, an empty and a NULL preference array, a duplicate preference key, a
holiday outside the window and one with an empty types array.
"""

from __future__ import annotations

import json
import os

from strata.sources.workbook import workbook_bytes

DEPARTMENTS = """department_id,department_name,cost_center
D1 ,Engineering,CC-1
D2,Sales ,CC-2
D3,People,
"""

JOB_ROLES = """job_role_id,job_title,job_level
J1,Engineer,L1
J2,Lead,L2
J3,Manager,L3
"""

# event_id, employee_id, event_type, event_date, department_id, job_role_id, manager, salary, notes
EVENTS = [
    ("V01", "P1", "HIRE", "2025-11-03", "D1", "J1", "", "100", "start"),
    ("V02", "P2", "HIRE", "2026-01-12", "D2", "J1", "P1", "90", ""),
    ("V03", "P3", "hire", "05-01-2026", "D3", "J2", "P1", "95", "day-first date"),
    ("V04", "P1", "PROMOTION", "2026-02-01", "D1", "J2", "", "120", ""),
    ("V05", "P2", "TRANSFER", "2026-03-16", "D1", "J1", "P1", "90", ""),
    ("V06", "P2", "SALARY_CHANGE", "2026-04-01", "D1", "J1", "P1", "99", ""),
    ("V07", "P3", "RESIGNATION", "2026-04-30", "D3", "J2", "P1", "95", "left"),
    ("V08", "P4", "HIRE", "2026-02-20", "D2", "J3", "", "130", ""),
    ("V09", "P1", "TRANSFER", "2026-06-01", "D2", "J2", "P4", "120", ""),
]

EMPLOYEES_HEADER = ["employee_id", "first_name", "last_name", "email", "hire_date",
                    "termination_date", "department_id", "job_role_id",
                    "manager_employee_id", "salary", "is_active"]
EMPLOYEES = [
    ["P1", "Ada", "Byron", "ada@example.test", "2025-11-03", "", "D2", "J2", "P4", 120.0, "TRUE"],
    ["P2", "Bo", "Chen", "bo@example.test  ", "2026-01-12", "", "D1", "J1", "P1", "99", "TRUE"],
    ["P3", "Cy", "Diaz", "cy@example.test", "2026-01-05", "2026-04-30", "D3", "J2", "P1", 95,
     "FALSE"],
    ["P4", "Di", "Eze", "di@example.test", "2026-02-20", "", "D2", "J3", None, 130, "true"],
]


def _contact(eid, mobile, work_email, ec, prefs):
    return {
        "employee_id": eid,
        "contact": {"phone": {"mobile": mobile, "work": "+1 555 0100", "home": None},
                    "email": {"personal": f"{eid.lower()}@home.test", "work": work_email}},
        "address": {"line1": "1 Main St", "line2": None, "city": "Springfield",
                    "state_or_province": "ST", "postal_code": "00001", "country_code": "US"},
        "emergency_contact": ec,
        "preferences": prefs,
        "metadata": {"source_system": "hris", "last_updated": "2026-06-01T10:00:00Z",
                     "schema_version": "2"},
    }


CONTACTS = [
    _contact("P1", "+1 555 0101", "p1@work.test",
             {"full_name": "Kim", "relationship": "sibling",
              "contact": {"phone": "+1 555 0199", "email": "kim@x.test"}},
             [{"key": "notification_channel", "value": "email"},
              {"key": "preferred_language", "value": "en"},
              {"key": "timezone", "value": "UTC"},
              {"key": "timezone", "value": "CET"}]),
    _contact("P2", "call reception", "p2@work.test", None,
             [{"key": "preferred_language", "value": "fr"}]),
    _contact("P3", None, None,
             {"full_name": "Lee", "relationship": "parent",
              "contact": {"phone": None, "email": None}}, []),
    _contact("P4", "+1 555 0104", "p4@work.test",
             {"full_name": "Max", "relationship": "partner",
              "contact": {"phone": "+1 555 0198", "email": None}}, None),
]

HOLIDAYS = [
    {"date": "2026-01-01", "localName": "New Year", "name": "New Year's Day", "countryCode": "GB",
     "fixed": True, "global": True, "counties": None, "launchYear": None, "types": ["Public"]},
    {"date": "2026-05-25", "localName": "Spring", "name": "Spring Bank Holiday",
     "countryCode": "GB", "fixed": False, "global": True, "counties": None, "launchYear": 1971,
     "types": ["Public", "Bank"]},
    {"date": "2026-07-04", "localName": "Independence", "name": "Independence Day",
     "countryCode": "US", "fixed": True, "global": True, "counties": None, "launchYear": None,
     "types": ["Public"]},
    {"date": "2026-03-30", "localName": "Local", "name": "Local Day", "countryCode": "IN",
     "fixed": False, "global": False, "counties": ["X"], "launchYear": None, "types": []},
]


def write_landing(root: str) -> str:
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "departments.csv"), "w") as f:
        f.write(DEPARTMENTS)
    with open(os.path.join(root, "job_roles.csv"), "w") as f:
        f.write(JOB_ROLES)
    with open(os.path.join(root, "employee_events.csv"), "w") as f:
        f.write("event_id,employee_id,event_type,event_date,department_id,job_role_id,"
                "manager_employee_id,salary,notes\n")
        for r in EVENTS:
            f.write(",".join(r) + "\n")
    with open(os.path.join(root, "employees.xlsx"), "wb") as f:
        f.write(workbook_bytes("employees", EMPLOYEES_HEADER, EMPLOYEES))
    with open(os.path.join(root, "employee_contact_info.json"), "w") as f:
        json.dump(CONTACTS, f, indent=2)
    with open(os.path.join(root, "public_holidays.json"), "w") as f:
        json.dump(HOLIDAYS, f, indent=2)
    return root
