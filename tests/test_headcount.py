"""Delta-form headcount vs the reference formula evaluated by brute force."""

import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from attrix.operators.headcount import (month_spine, monthly_combined, monthly_exits,
                                        monthly_headcount)
from attrix.operators.joins import lifecycle

LIFE = T.StructType([T.StructField("employee_key", T.StringType()),
                     T.StructField("location_state", T.StringType()),
                     T.StructField("hire_date", T.DateType()),
                     T.StructField("termination_date", T.DateType())])


def months(start, end_excl):
    out, y, m = [], start.year, start.month
    while dt.date(y, m, 1) < dt.date(end_excl.year, end_excl.month, 1):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def brute(rows, start, end_excl):
    """count(key) grouped by (month, state) over months × rows with the as-of predicate."""
    res = {}
    for m in months(start, end_excl):
        me = dt.date(m.year, m.month, calendar.monthrange(m.year, m.month)[1])
        for k, st, h, t in rows:
            if h is not None and h <= me and (t is None or t > me):
                key = (m, st)
                res[key] = res.get(key, 0) + (1 if k is not None else 0)
    return res


def rand_rows(rng, n):
    states = ["A", "B", "C", None]
    out = []
    for i in range(n):
        h = None if rng.random() < 0.05 else dt.date(2010, 1, 1) + dt.timedelta(days=rng.randint(0, 4000))
        t = None
        if rng.random() < 0.6:
            base = h or dt.date(2015, 1, 1)
            t = base + dt.timedelta(days=rng.randint(-200, 2000))
        # exits on month ends / first days, exit before hire, null keys
        if rng.random() < 0.05 and t:
            t = dt.date(t.year, t.month, calendar.monthrange(t.year, t.month)[1])
        if rng.random() < 0.05 and t:
            t = dt.date(t.year, t.month, 1)
        k = None if rng.random() < 0.03 else f"k{i % (n // 2 + 1)}"  # repeat keys: repeat leavers
        out.append((k, rng.choice(states), h, t))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_delta_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = rand_rows(rng, 400)
    start, end = dt.date(2015, 1, 1), dt.date(2021, 7, 1)
    df = spark.createDataFrame(rows, LIFE)
    got = {(r["month_start"], r["location_state"]): r["headcount"]
           for r in monthly_headcount(df, start, end).collect()}
    assert got == brute(rows, start, end)


def test_month_end_and_first_of_month(spark):
    rows = [("a", "X", dt.date(2020, 1, 31), dt.date(2020, 3, 31)),   # hired on month end
            ("b", "X", dt.date(2020, 2, 1), dt.date(2020, 3, 1)),     # exit on the 1st
            ("c", "X", dt.date(2014, 6, 1), None),                    # hired before spine
            ("d", "X", dt.date(2020, 5, 1), dt.date(2020, 4, 1))]     # exit before hire
    df = spark.createDataFrame(rows, LIFE)
    start, end = dt.date(2020, 1, 1), dt.date(2020, 7, 1)
    got = {(r["month_start"], r["location_state"]): r["headcount"]
           for r in monthly_headcount(df, start, end).collect()}
    assert got == brute(rows, start, end)


def test_spine_exclusive_and_empty(spark):
    sp = month_spine(spark, "2024-11-01", "2025-02-15").collect()
    assert [r["month_start"].isoformat() for r in sp] == ["2024-11-01", "2024-12-01", "2025-01-01"]
    assert sp[-1]["month_end"] == dt.date(2025, 1, 31)
    assert month_spine(spark, "2025-03-01", "2025-03-20").count() == 0


def test_zero_headcount_month_drops_row_and_its_exits(spark):
    # the only employee of state G leaves in September: no September row, exit not counted
    life = spark.createDataFrame([("g", "G", dt.date(2024, 1, 5), dt.date(2024, 9, 15))], LIFE)
    hc = monthly_headcount(life, "2024-01-01", "2025-01-01")
    assert max(r["month_start"] for r in hc.collect()) == dt.date(2024, 8, 1)
    fct = spark.createDataFrame(
        [("g", "G", dt.date(2024, 9, 15), True, False)],
        "employee_key string, location_state string, termination_date date, "
        "is_voluntary boolean, is_regrettable boolean")
    comb = monthly_combined(hc, monthly_exits(fct)).collect()
    assert sum(r["total_terminations"] for r in comb) == 0


def test_lifecycle_fans_out_repeat_leavers(spark):
    dim = spark.createDataFrame(
        [("k1", "e1", dt.date(2020, 1, 1), "S", "US", "D"), ("k2", "e2", dt.date(2020, 1, 1), "S", "US", "D")],
        "employee_key string, employee_id string, hire_date date, location_state string, "
        "location_country string, department string")
    fct = spark.createDataFrame([("k1", dt.date(2021, 1, 1)), ("k1", dt.date(2022, 1, 1))],
                                "employee_key string, termination_date date")
    rows = sorted((r["employee_key"], r["termination_date"]) for r in lifecycle(dim, fct).collect())
    assert rows == [("k1", dt.date(2021, 1, 1)), ("k1", dt.date(2022, 1, 1)), ("k2", None)]


def test_dense_keeps_zero_months_and_their_exits(spark):
    life = spark.createDataFrame([("g", "G", dt.date(2024, 1, 5), dt.date(2024, 9, 15))], LIFE)
    hc = monthly_headcount(life, "2024-01-01", "2025-01-01", dense=True)
    rows = {r["month_start"]: r["headcount"] for r in hc.collect()}
    assert rows[dt.date(2024, 8, 1)] == 1 and rows[dt.date(2024, 9, 1)] == 0
    assert max(rows) == dt.date(2024, 12, 1)
    fct = spark.createDataFrame([("g", "G", dt.date(2024, 9, 15), True, False)],
                                "employee_key string, location_state string, termination_date date, "
                                "is_voluntary boolean, is_regrettable boolean")
    assert sum(r["total_terminations"] for r in monthly_combined(hc, monthly_exits(fct)).collect()) == 1


from hypothesis import HealthCheck, given, settings, strategies as st  # noqa: E402

_day = st.one_of(st.none(), st.dates(min_value=dt.date(2013, 1, 1), max_value=dt.date(2021, 12, 31)))
_row = st.tuples(st.one_of(st.none(), st.sampled_from(["k1", "k2", "k3", "k4"])),
                 st.one_of(st.none(), st.sampled_from(["A", "B"])), _day, _day)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(_row, min_size=1, max_size=25))
def test_delta_headcount_hypothesis(spark, rows):
    start, end = dt.date(2015, 1, 1), dt.date(2020, 1, 1)
    got = {(r["month_start"], r["location_state"]): r["headcount"]
           for r in monthly_headcount(spark.createDataFrame(rows, LIFE), start, end).collect()}
    assert got == brute(rows, start, end)
