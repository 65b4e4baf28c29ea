"""The declared data-quality suite for the turnover models.

The lists are data: (model, column, test, args, severity). Severity is
``error`` for staging, dimension and fact models and ``warn`` for the rolling
mart. ``not_before_column(termination_date, hire_date)`` is declared on the
termination fact, which is the model that carries both columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from attrix.operators import quality as Q, runs as RN
from attrix.operators.quality import Check
from attrix.schema import (EMPLOYMENT_STATUSES, MAX_EXPECTED_TURNOVER_RATE, TENURE_BUCKETS,
                           TERMINATION_REASONS, TERMINATION_TYPES, UNKNOWN_BUCKET, WORKER_TYPES)

_TENURE_LABELS = [label for _, label in TENURE_BUCKETS]


def _cols(model, cols, test, severity="error", **args):
    return [Check(model, c, test, dict(args), severity) for c in cols]


# The declared checks, their columns and severities.
def suite(as_of) -> list[Check]:
    E, T, D, F, R = "stg_employees", "stg_terminations", "dim_employees", "fct_terminations", "turnover"
    return [
        *_cols(E, ["employee_key", "employee_id"], "unique"),
        *_cols(E, ["employee_key", "employee_id", "first_name", "last_name", "full_name",
                   "location_state", "location_country", "hire_date", "employment_status",
                   "worker_type", "is_active", "snapshot_date"], "not_null"),
        Check(E, "hire_date", "not_in_future", {"as_of": as_of}),
        Check(E, "employment_status", "accepted_values", {"values": EMPLOYMENT_STATUSES}),
        Check(E, "worker_type", "accepted_values", {"values": WORKER_TYPES}),

        *_cols(T, ["termination_key", "termination_id"], "unique"),
        *_cols(T, ["termination_key", "employee_key", "termination_id", "employee_id",
                   "termination_date", "termination_type", "termination_reason",
                   "rehire_eligible", "is_voluntary", "termination_year", "termination_month",
                   "termination_month_start", "snapshot_date"], "not_null"),
        Check(T, "employee_key", "relationships", {"to": E, "field": "employee_key"}),
        Check(T, "termination_date", "not_in_future", {"as_of": as_of}),
        Check(T, "termination_type", "accepted_values", {"values": TERMINATION_TYPES}),
        Check(T, "termination_reason", "accepted_values", {"values": TERMINATION_REASONS}),

        *_cols(D, ["employee_key", "employee_id"], "unique"),
        *_cols(D, ["employee_key", "employee_id", "full_name", "employment_status", "is_active",
                   "hire_date", "location_state", "tenure_bucket", "is_manager"], "not_null"),
        Check(D, "employment_status", "accepted_values", {"values": EMPLOYMENT_STATUSES}),
        Check(D, "tenure_bucket", "accepted_values", {"values": _TENURE_LABELS}),

        *_cols(F, ["termination_key", "termination_id"], "unique"),
        *_cols(F, ["termination_key", "termination_id", "employee_key", "termination_date",
                   "termination_type", "termination_reason", "is_voluntary", "rehire_eligible",
                   "tenure_at_exit_bucket", "is_regrettable", "termination_month_start"], "not_null"),
        Check(F, "employee_key", "relationships", {"to": D, "field": "employee_key"}),
        Check(F, "termination_type", "accepted_values", {"values": TERMINATION_TYPES}),
        Check(F, "tenure_at_exit_bucket", "accepted_values",
              {"values": _TENURE_LABELS + [UNKNOWN_BUCKET]}),
        Check(F, "termination_date", "not_before_column", {"reference_column": "hire_date"}),

        *_cols(R, ["month_start", "month_end", "location_state", "eom_headcount",
                   "rolling_12m_avg_headcount", "total_terminations", "rolling_12m_terminations",
                   "is_partial_window", "months_in_window"], "not_null", severity="warn"),
        Check(R, "rolling_12m_turnover_rate", "is_between",
              {"min_value": 0, "max_value": MAX_EXPECTED_TURNOVER_RATE}, "warn"),
    ]


def business_rules(models: dict[str, DataFrame], runs: DataFrame | None = None, now=None) -> dict:
    """The singular checks: name → (model, severity, failing rows or their condition).

    With the run log and the time of the check, ``pipeline_ran_recently`` is among them.
    """
    E, T, D, F, R = (models[k] for k in ("stg_employees", "stg_terminations", "dim_employees",
                                         "fct_terminations", "turnover"))
    rules = {
        "termination_after_hire": ("fct_terminations", "error", Q.termination_after_hire(F)),
        "last_day_lte_termination": ("stg_terminations", "error", Q.ROW_RULES["last_day_lte_termination"]()),
        "active_with_termination": ("stg_employees", "warn", Q.active_with_termination(E, T)),
        "terminated_without_exit": ("dim_employees", "warn", Q.terminated_without_exit(D, F)),
        "headcount_non_negative": ("turnover", "error", Q.ROW_RULES["headcount_non_negative"]()),
        "regrettable_subset": ("turnover", "error", Q.ROW_RULES["regrettable_subset"]()),
        "types_sum_to_total": ("turnover", "error", Q.ROW_RULES["types_sum_to_total"]()),
        "spine_contiguous": ("turnover", "error", Q.spine_contiguous(R)),
    }
    if runs is not None:
        rules["pipeline_ran_recently"] = ("runs", "error", RN.ran_recently(runs, now))
    return rules
