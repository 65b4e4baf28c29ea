"""Dimension, fact and turnover mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from attrix.functions import (as_date, days_between, flag, month_start, surrogate_key,
                              tenure_bucket)
from attrix.operators.headcount import (headcount_rows, monthly_combined, monthly_exits,
                                        monthly_headcount)
from attrix.operators.joins import flag_referenced
from attrix.operators.rolling import rolling_turnover
from attrix.schema import REGRETTABLE_MIN_TENURE_DAYS, ROLLING_MONTHS, SPINE_START

# Model column lists that consumers of the models rely on.
DIM_COLUMNS = [
    "employee_key", "employee_id", "first_name", "last_name", "full_name", "email",
    "job_title", "department", "worker_type", "manager_id", "location_city",
    "location_state", "location_country", "employment_status", "is_active", "hire_date",
    "hire_year", "hire_quarter", "hire_month_start", "tenure_days", "tenure_bucket",
    "is_manager", "snapshot_date",
]


def dim_employees(stg: DataFrame) -> DataFrame:
    """One row per employee with hire calendar fields, tenure bucket and manager flag.

    The manager flag compares surrogate keys (``employee_key`` with the key of each
    non-null ``manager_id``), which is equality of ids, so the join keeps the
    staging model's partitioning on the employee key.
    """
    managers = (stg.where(F.col("manager_id").isNotNull())
                   .select(surrogate_key("manager_id").alias("manager_key")))
    e = flag_referenced(stg, "employee_key", managers, "manager_key", out="is_manager")
    return e.select(
        *DIM_COLUMNS[:16],
        F.year("hire_date").alias("hire_year"),
        F.quarter("hire_date").alias("hire_quarter"),
        month_start("hire_date").alias("hire_month_start"),
        "tenure_days",
        tenure_bucket(F.col("tenure_days")).alias("tenure_bucket"),
        "is_manager", "snapshot_date",
    )


_FROM_DIM = ["full_name", "first_name", "last_name", "email", "job_title", "department",
             "worker_type", "location_city", "location_state", "location_country",
             "manager_id", "is_manager", "hire_date"]


def fct_terminations(stg_t: DataFrame, dim: DataFrame) -> DataFrame:
    """Each termination with the employee's current profile; unmatched exits are kept.

    Left join on the employee key: the termination side may hold a hot key (a
    repeat leaver); it is the left side of a left outer join, which AQE's
    skew-join handling can split.
    """
    e = dim.select(F.col("employee_key").alias("_ek"), *_FROM_DIM)
    j = stg_t.join(e, stg_t["employee_key"] == e["_ek"], "left")
    tenure = days_between("hire_date", "termination_date")
    return j.select(
        "termination_key", "termination_id", "employee_key", "employee_id",
        *_FROM_DIM, "termination_date", "last_day_of_work", "termination_type",
        "termination_reason", "termination_reason_detail", "is_voluntary", "rehire_eligible",
        "notice_period_days", "recorded_by", "recorded_at",
        F.when(F.col("hire_date").isNotNull() & F.col("termination_date").isNotNull(), tenure)
         .alias("tenure_at_exit_days"),
        tenure_bucket(tenure, unknown_when=F.col("hire_date").isNull()).alias("tenure_at_exit_bucket"),
        "termination_year", "termination_month", "termination_month_start",
        F.quarter("termination_date").alias("termination_quarter"),
        flag(F.col("is_voluntary") & F.col("hire_date").isNotNull()
             & (tenure >= REGRETTABLE_MIN_TENURE_DAYS)).alias("is_regrettable"),
        "snapshot_date",
    )


def turnover_mart(dim: DataFrame, fct: DataFrame, as_of, spine_start=SPINE_START,
                  months: int = ROLLING_MONTHS, group: str = "location_state",
                  dense: bool = False) -> DataFrame:
    """Monthly rolling turnover per group: spine → headcount → exits → rolling rates.

    The spine ends before ``as_of``'s month (exclusive end), and rows after that
    month are dropped.
    """
    hc = monthly_headcount(headcount_rows(dim, fct, group=group), spine_start, as_date(as_of), group=group,
                           dense=dense, weight="weight")
    monthly = monthly_combined(hc, monthly_exits(fct, group=group), group=group)
    return rolling_turnover(monthly, months=months, group=group, as_of=as_of)
