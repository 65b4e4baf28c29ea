import datetime as dt

from attrix.operators import quality as Q
from attrix.operators.quality import Check


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert [tuple(r) for r in Q.unique(df, "k").collect()] == [("a", 2)]


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("X",), ("Y",), ("Z",), ("Z",), (None,)], "v string")
    assert sorted(tuple(r) for r in Q.accepted_values(df, "v", ["X", "Y"]).collect()) == [("Z", 2)]


def test_generic_date_checks(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 2, 1)),
                                (dt.date(2026, 1, 1), dt.date(2020, 1, 1)),
                                (dt.date(2026, 1, 1), dt.date(2020, 1, 1)),
                                (None, dt.date(2020, 1, 1))], "t date, h date")
    assert [tuple(r) for r in Q.not_in_future(df, "t", "2025-01-01").collect()] == [(dt.date(2026, 1, 1), 2)]
    assert [tuple(r) for r in Q.not_before_column(df, "t", "h").collect()] == \
        [(dt.date(2024, 1, 1), dt.date(2024, 2, 1), 1)]


def test_is_between_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (150.0,), (150.01,), (-0.5,), (None,)], "r double")
    assert sorted(r.failing_value for r in Q.is_between(df, "r", 0, 150).collect()) == [-0.5, 150.01]


def test_freshness_bands(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 0, 30),)], "w timestamp_ntz")
    status = lambda now: Q.freshness(df, "w", now).first().status
    assert status("2024-07-02 01:30:00") == "pass"    # 25 hours to the second
    assert status("2024-07-02 01:30:01") == "warn"
    assert status("2024-07-02 02:20:00") == "warn"    # 25 h 50 min
    assert status("2024-07-03 00:30:00") == "warn"    # 48 hours: not above the error bound
    assert status("2024-07-03 00:30:01") == "error"
    empty = spark.createDataFrame([], "w timestamp_ntz")
    assert Q.freshness(empty, "w", "2024-07-02 00:00:00").first().status == "error"


def test_business_rules(spark):
    mart = spark.createDataFrame(
        [("S", dt.date(2024, 1, 1), 5, 2, 1, 1, 3, 4, 2, 1),
         ("S", dt.date(2024, 3, 1), -1, 1, 1, 0, 2, 2, 1, 1)],
        "location_state string, month_start date, eom_headcount long, total_terminations long, "
        "voluntary_terminations long, involuntary_terminations long, regrettable_terminations long, "
        "rolling_12m_terminations long, rolling_12m_voluntary long, rolling_12m_involuntary long")
    mart = mart.withColumn("rolling_12m_regrettable", mart.rolling_12m_voluntary)
    assert Q.headcount_non_negative(mart).count() == 1
    assert Q.regrettable_subset(mart).count() == 2          # 3 > 1 and 2 > 1 regrettable vs voluntary
    assert Q.types_sum_to_total(mart).count() == 1          # row 1: rolling 2 + 1 != 4
    gaps = Q.spine_contiguous(mart).collect()
    assert [(r.previous_month, r.month_start) for r in gaps] == [(dt.date(2024, 1, 1), dt.date(2024, 3, 1))]


def test_suite_counts_and_severity(spark):
    df = spark.createDataFrame([("a", None), ("a", "x")], "k string, v string")
    checks = [Check("m", "k", "unique"), Check("m", "v", "not_null"), Check("m", "k", "not_null"),
              Check("m", "v", "accepted_values", {"values": ["x"]}, "warn")]
    res = {r.test: (r.failures, r.severity) for r in Q.run_suite(checks, {"m": df}).collect()}
    assert res == {"unique_m_k": (1, "error"), "not_null_m_v": (1, "error"),
                   "not_null_m_k": (0, "error"), "accepted_values_m_v": (0, "warn")}


def test_pairs_of_values_are_counted_apart(spark):
    """Two values that would read alike once joined by a separator are two failing values."""
    df = spark.createDataFrame([("a", "b|c"), ("a|b", "c"), ("a|b", "c")], "x string, y string")
    check = Check("m", "x", "not_before_column", {"reference_column": "y"})
    assert Q.run_suite([check], {"m": df}).first().failures == Q.failing_rows(check, {"m": df}).count() == 2


def test_row_rules_and_run_log_in_the_suite(spark):
    from attrix.operators import runs as RN
    from attrix.schema import RUNS
    stg = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1))],
                                "last_day_of_work date, termination_date date")
    runs = spark.createDataFrame([], RUNS)
    rules = {"last_day_lte_termination": ("stg_terminations", "error", Q.ROW_RULES["last_day_lte_termination"]()),
             "pipeline_ran_recently": ("runs", "error", RN.ran_recently(runs, "2024-01-01 00:00:00"))}
    got = {r.test: r.failures for r in Q.run_suite([Check("stg_terminations", "last_day_of_work", "not_null")],
                                                   {"stg_terminations": stg}, rules).collect()}
    assert got == {"not_null_stg_terminations_last_day_of_work": 1, "last_day_lte_termination": 1, "pipeline_ran_recently": 1}


def test_the_suite_reads_models_that_are_bucketed_by_employee(spark):
    from attrix.plans import registry as R
    plan = R.q_dq_suite(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
