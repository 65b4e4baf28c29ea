"""A small invented company: joiners, leavers, an emptied state, unknown and repeat leavers, a late entry.

Only the columns the metrics need carry values of their own; the others hold placeholders.
"""

import datetime as dt

from attrix.schema import RAW_EMPLOYEE, RAW_TERMINATION

D = dt.date.fromisoformat
RUN = D("2025-04-01")
WRITTEN = dt.datetime(2025, 4, 1, 2, 0, 0)

# employee_id, state, hire_date, status, manager_id
EMPLOYEES = [
    ("A1", "OR", "2016-05-31", "Active", None),
    ("A2", "OR", "2022-09-12", "Active", "A1"),
    ("A3", "OR", "2019-01-02", "Terminated", "A1"),
    ("A4", "OR", "2024-12-30", "Active", "A2"),
    ("B1", "VT", "2023-02-28", "Terminated", "A1"),       # the only one there
    ("C1", "NM", "2014-06-16", "Active", "Z9"),           # hired before the spine starts
    ("C2", "NM", "2020-11-05", "Terminated", "C1"),       # leaves twice
    ("C3", "NM", "2024-07-01", "Terminated", "C1"),       # leaves within three months
    ("C4", "NM", "2021-03-15", "Terminated", "C1"),       # terminated, no record of it
    ("D1", None, "2021-01-04", "Active", "C1"),           # no state
]

# id, employee, termination_date, last_day, type, reason
TERMINATIONS = [
    ("L1", "A3", "2024-05-31", "2024-05-24", "Voluntary", "Resignation"),
    ("L2", "B1", "2024-10-01", "2024-10-01", "Involuntary", "Layoff"),
    ("L3", "C2", "2022-08-19", "2022-08-19", "Voluntary", "Retirement"),
    ("L4", "C2", "2024-11-30", "2024-11-15", "Involuntary", "Performance"),
    ("L5", "C3", "2024-09-10", "2024-09-10", "Voluntary", "Resignation"),
    ("L6", "X1", "2024-04-02", "2024-03-29", "Voluntary", "Resignation"),          # unknown employee
    ("L7", "X2", "2023-12-15", "2023-12-15", "Involuntary", "Termination for Cause"),
]


def raw_employees(spark, rows=EMPLOYEES, run_date=RUN):
    data = [(eid, f"First{eid}", f"Last{eid}", f"{eid}@example.org", "Clerk",
             "Store", "Town", st, "USA", D(h), status, "Employee", mgr,
             "employees", run_date, 0, WRITTEN, WRITTEN)
            for eid, st, h, status, mgr in rows]
    return spark.createDataFrame(data, RAW_EMPLOYEE)


def raw_terminations(spark, rows=TERMINATIONS, run_date=RUN):
    data = [(tid, eid, D(td), D(ld), ty, rs, "detail", True, "hr", WRITTEN,
             "terminations", run_date, 0, WRITTEN, WRITTEN)
            for tid, eid, td, ld, ty, rs in rows]
    return spark.createDataFrame(data, RAW_TERMINATION)
