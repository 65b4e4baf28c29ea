"""Declared schemas and controlled vocabularies.

Every table is declared once here; readers always pass a schema, never infer.
Integers are LongType because page files written by pandas/pyarrow hold INT64.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Timestamps are UTC instants kept as UTC wall-clock values without a zone
# (TIMESTAMP_NTZ): they compare the same in every engine and session.
S, D, L, B, TS = (T.StringType(), T.DateType(), T.LongType(), T.BooleanType(),
                  T.TimestampNTZType())


def _struct(*fields, nullable=True) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


# Lineage columns injected by the stager, present in both raw tables.
LINEAGE_FIELDS = [
    ("_pipeline_entity", S),
    ("_pipeline_run_date", D),
    ("_pipeline_page_num", L),
    ("_pipeline_written_at", TS),
]
LOADED_AT = ("_loaded_at", TS)

EMPLOYEE_FIELDS = [
    ("employee_id", S), ("first_name", S), ("last_name", S), ("email", S),
    ("job_title", S), ("department", S), ("location_city", S),
    ("location_state", S), ("location_country", S), ("hire_date", D),
    ("employment_status", S), ("worker_type", S), ("manager_id", S),
]

TERMINATION_FIELDS = [
    ("termination_id", S), ("employee_id", S), ("termination_date", D),
    ("last_day_of_work", D), ("termination_type", S), ("termination_reason", S),
    ("termination_reason_detail", S), ("rehire_eligible", B), ("recorded_by", S),
    ("recorded_at", TS),
]

# API records: dates and the entry timestamp arrive as ISO strings.
API_EMPLOYEE = _struct(*[(n, S if t == D else t) for n, t in EMPLOYEE_FIELDS])
API_TERMINATION = _struct(*[(n, S if t in (D, TS) else t) for n, t in TERMINATION_FIELDS])

# Landing (staged Parquet) files: dates coerced, recorded_at still a string.
LANDING_EMPLOYEE = _struct(*EMPLOYEE_FIELDS, *LINEAGE_FIELDS)
LANDING_TERMINATION = _struct(
    *[(n, S if n == "recorded_at" else t) for n, t in TERMINATION_FIELDS], *LINEAGE_FIELDS)

RAW_EMPLOYEE = _struct(*EMPLOYEE_FIELDS, *LINEAGE_FIELDS, LOADED_AT)
RAW_TERMINATION = _struct(*TERMINATION_FIELDS, *LINEAGE_FIELDS, LOADED_AT)

RUNS = T.StructType([
    T.StructField("run_id", S, False),
    T.StructField("run_date", D, False),
    T.StructField("entity", S, False),
    T.StructField("records_staged", L, False),
    T.StructField("s3_key", S, True),          # JSON array of written file paths
    T.StructField("status", S, False),
    T.StructField("started_at", TS, False),
    T.StructField("completed_at", TS, True),
    T.StructField("error_message", S, True),
])

LOAD_HISTORY = _struct(
    ("file_name", S), ("file_size", L), ("row_count", L), ("row_parsed", L),
    ("first_error_message", S), ("status", S), ("last_load_time", TS))


def envelope(record_schema: T.StructType) -> T.StructType:
    """Report envelope: metadata plus a ``data`` array of records."""
    return _struct(("report_name", S), ("generated_at", S), ("tenant", S),
                   ("total_records", L), ("data", T.ArrayType(record_schema)))


LANDING = {"employees": LANDING_EMPLOYEE, "terminations": LANDING_TERMINATION}
RAW = {"employees": RAW_EMPLOYEE, "terminations": RAW_TERMINATION}
API = {"employees": API_EMPLOYEE, "terminations": API_TERMINATION}
NATURAL_KEY = {"employees": "employee_id", "terminations": "termination_id"}
DATE_COLUMNS = ("hire_date", "termination_date", "last_day_of_work")

# --- fixed values (must equal the reference's vocabularies and labels) -------
EMPLOYMENT_STATUSES = ["ACTIVE", "TERMINATED"]
WORKER_TYPES = ["EMPLOYEE", "CONTRACTOR"]
TERMINATION_TYPES = ["VOLUNTARY", "INVOLUNTARY"]
TERMINATION_REASONS = ["RESIGNATION", "RETIREMENT", "LAYOFF", "PERFORMANCE",
                       "TERMINATION FOR CAUSE"]
# API-side filter vocabularies (case as the report API accepts them)
API_EMPLOYMENT_STATUSES = ["Active", "Terminated", "All"]
API_TERMINATION_TYPES = ["Voluntary", "Involuntary"]
# Tenure buckets: (exclusive upper bound in days, label); last label has no bound.
TENURE_BUCKETS = [(90, "1. 0-90 days"), (365, "2. 91-365 days"), (730, "3. 1-2 years"),
                  (1825, "4. 2-5 years"), (None, "5. 5+ years")]
UNKNOWN_BUCKET = "Unknown"
REGRETTABLE_MIN_TENURE_DAYS = 730
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
RUN_STATUSES = ["SUCCESS", "FAILED"]
RUN_ENTITIES = ["employees", "terminations", "pipeline"]
PAGE_SIZE = 500
# Raw-table clustering columns (common filters): rows are sorted on them before writing
RAW_CLUSTER = {"employees": ["_pipeline_run_date", "employment_status"],
               "terminations": ["termination_date", "termination_type"]}
MAX_EXPECTED_TURNOVER_RATE = 150
STALE_AFTER_HOURS = 25
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 25, 48
SPINE_START = "2015-01-01"
ROLLING_MONTHS = 12
