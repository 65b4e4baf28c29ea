"""Every materialisation choice gives the same models."""

import seed
from attrix.plans.build import build, cached, checkpointed, lazy, written
from attrix.session import scratch_path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_materializers_agree(spark):
    e, t = seed.raw_employees(spark), seed.raw_terminations(spark)
    base = build(e, t, "2025-04-01", "2015-01-01", materialize=lazy)
    for m in (written(spark, scratch_path(spark, "t-build")), checkpointed(spark), cached(spark)):
        other = build(e, t, "2025-04-01", "2015-01-01", materialize=m, materialize_staging=True)
        for name in ("dim_employees", "fct_terminations", "turnover"):
            assert _rows(other[name]) == _rows(base[name]), name


def test_written_marts_are_tables(spark):
    e, t = seed.raw_employees(spark), seed.raw_terminations(spark)
    m = build(e, t, "2025-04-01", "2015-01-01", materialize=written(spark, scratch_path(spark, "t-tbl")))
    # a written model is a plain file scan: lineage is cut
    plan = m["turnover"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Window" not in plan


def test_bucketed_models_join_without_shuffle(spark):
    from attrix.operators.joins import lifecycle
    from attrix.plans.build import bucketed
    e, t = seed.raw_employees(spark), seed.raw_terminations(spark)
    base = build(e, t, "2025-04-01", "2015-01-01")
    m = build(e, t, "2025-04-01", "2015-01-01",
              materialize=bucketed(spark, scratch_path(spark, "t-bkt"), 4), materialize_staging=True)
    for name in ("dim_employees", "fct_terminations", "turnover"):
        assert _rows(m[name]) == _rows(base[name]), name
    # with broadcasts off (as for large tables) the joins read matching buckets: no shuffle
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        life = lifecycle(m["dim_employees"], m["fct_terminations"])
        life.collect()
        plan = life._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dashboard_reads(spark):
    from attrix.plans.dashboard import exits, turnover
    e, t = seed.raw_employees(spark), seed.raw_terminations(spark)
    base = scratch_path(spark, "t-dash")
    m = build(e, t, "2025-04-01", "2015-01-01", materialize=written(spark, base))
    state = turnover(spark, f"{base}/turnover", "OR")
    assert state.count() == 107                                  # May 2016 to March 2025
    cell = state.where("month_start = date'2024-05-01'").first()
    found = exits(m["fct_terminations"], "OR", "2024-05-17")
    drill = found.collect()
    assert cell.total_terminations == len(drill) == 1 and drill[0].termination_id == "L1"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 2024-05-01)" in plan and "trunc(" not in plan     # a range that the scan can use


def test_models_as_sql_views(spark):
    e, t = seed.raw_employees(spark), seed.raw_terminations(spark)
    build(e, t, "2025-04-01", "2015-01-01", views=True)
    from test_seed_golden import expected_mart
    assert spark.sql("SELECT count(*) AS n FROM fct_turnover_rolling_12m").first().n == len(expected_mart())
    r = spark.sql("""SELECT location_state, sum(total_terminations) AS exits
                     FROM fct_turnover_rolling_12m GROUP BY 1 ORDER BY 1""").collect()
    assert [(x.location_state, x.exits) for x in r] == [(None, 0), ("NM", 3), ("OR", 1), ("VT", 0)]
    assert spark.sql("SELECT count(*) AS n FROM fct_terminations WHERE location_state IS NULL").first().n == 2


def test_lookup_key_reaches_below_the_window(spark):
    """The surrogate key's equality passes the de-duplication: one key's rows are shuffled, not the table."""
    from attrix.operators.filters import lookup
    from attrix.plans.staging import stage_employees
    df = lookup(stage_employees(seed.raw_employees(spark), "2025-04-01"), "employee_id", "A1", hashed_key="employee_key")
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    window = next(i for i, x in enumerate(lines) if "Window [" in x)
    assert any("Filter" in x and "md5" in x for x in lines[window:]) and df.count() == 1


def test_stage_reads_its_input_once(spark, tmp_path):
    from attrix.schema import API_EMPLOYEE
    from attrix.sources.landing import api_records, stage
    seen = spark.sparkContext.accumulator(0)
    rows = api_records(seed.raw_employees(spark), "employees")

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    assert stage(rows.mapInArrow(count, API_EMPLOYEE), "employees", "2025-04-01", str(tmp_path / "l"))["records"] == len(seed.EMPLOYEES)
    assert seen.value == len(seed.EMPLOYEES)
