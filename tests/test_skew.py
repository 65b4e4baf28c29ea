"""Hot keys: one employee holds a third of all termination rows; one state a third of employees."""

import datetime as dt

from pyspark.sql import functions as F

from attrix.operators import quality as Q
from attrix.plans.build import build
from attrix.schema import RAW_EMPLOYEE, RAW_TERMINATION

W = dt.datetime(2025, 4, 1, 2)


def test_hot_keys_give_exact_results(spark):
    emps = [(f"E{i}", "f", "l", "e", "j", "d", "c", "HOT" if i % 3 == 0 else f"S{i % 5}", "US",
             dt.date(2018, 1, 1) + dt.timedelta(days=i), "Active", "Employee", "E0",
             "employees", dt.date(2025, 4, 1), 0, W, W) for i in range(300)]
    # 150 terminations for E0 (repeat leaver, re-loaded), 300 spread over others
    terms = [(f"T0-{j % 50}", "E0", dt.date(2020, 1, 1) + dt.timedelta(days=j), dt.date(2020, 1, 1),
              "Voluntary", "Resignation", "x", True, "hr", W, "terminations", dt.date(2025, 4, 1), j, W, W)
             for j in range(150)]
    terms += [(f"T{i}", f"E{i}", dt.date(2022, 1, 1) + dt.timedelta(days=i), dt.date(2022, 1, 1),
               "Involuntary", "Layoff", "x", False, "hr", W, "terminations", dt.date(2025, 4, 1), 0, W, W)
              for i in range(1, 301)]
    m = build(spark.createDataFrame(emps, RAW_EMPLOYEE).repartition(6),
              spark.createDataFrame(terms, RAW_TERMINATION).repartition(6), "2025-04-01", "2015-01-01")
    stg_t = m["stg_terminations"]
    assert stg_t.count() == 50 + 300                      # re-loads collapse to one row per id
    # the latest load of each T0-x is its last page (highest page number)
    t0 = {r.termination_id: r.termination_date for r in stg_t.where("employee_id = 'E0'").collect()}
    assert t0["T0-0"] == dt.date(2020, 1, 1) + dt.timedelta(days=100)
    fct = m["fct_terminations"]
    assert fct.where("employee_id = 'E0'").count() == 50
    assert Q.relationships(fct, "employee_key", m["dim_employees"], "employee_key").count() == 1  # E300
    assert m["dim_employees"].where("is_manager").count() == 1
    mart = m["turnover"]
    assert Q.types_sum_to_total(mart).count() == 0 and Q.headcount_non_negative(mart).count() == 0
    hot = mart.where("location_state = 'HOT'").agg(F.sum("total_terminations")).first()[0]
    # E0's 50 exits + the HOT state's other leavers (E3 … E297), except those whose month has
    # no row because the state's headcount reached zero (kept behaviour)
    months = {r.month_start for r in mart.where("location_state = 'HOT'").collect()}
    exits = [r.termination_date.replace(day=1) for r in fct.where("location_state = 'HOT'").collect()]
    assert len(exits) == 50 + 99
    assert hot == sum(1 for m0 in exits if m0 in months) < len(exits)
