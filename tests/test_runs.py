import datetime as dt

import pytest

from attrix.operators import filters as FL, runs as RN
from attrix.schema import RUNS

T = dt.datetime


def runs_df(spark, rows):
    return spark.createDataFrame(rows, RUNS)


def row(entity, run_date, status="SUCCESS", completed=None, n=1):
    started = T.combine(run_date, dt.time(2, 0))
    return (f"{entity}-{run_date}-{status}", run_date, entity, n, None, status, started,
            completed or started + dt.timedelta(minutes=5), None if status == "SUCCESS" else "boom")


def test_resolve_window_priorities(spark):
    d = dt.date
    r = runs_df(spark, [row("terminations", d(2024, 6, 29)), row("terminations", d(2024, 6, 30)),
                        row("terminations", d(2024, 7, 1), "FAILED"), row("employees", d(2024, 7, 1))])
    w = RN.resolve_window(r, "2024-07-02").first()
    assert (w.start_date, w.end_date, w.source, w.is_empty) == (d(2024, 7, 1), d(2024, 7, 2), "last_success", False)
    w = RN.resolve_window(r, "2024-07-02", start="2024-01-01").first()
    assert (w.start_date, w.source) == (d(2024, 1, 1), "override")
    w = RN.resolve_window(r, "2024-07-02", full_load=True).first()
    assert (w.start_date, w.source) == (None, "full_load")
    empty = runs_df(spark, [])
    w = RN.resolve_window(empty, "2024-07-02").first()
    assert (w.start_date, w.source) == (d(2024, 6, 2), "fallback")
    # second run on the same day: start is tomorrow -> empty window, not an error
    w = RN.resolve_window(r, "2024-06-30").first()
    assert w.is_empty is True


def test_ran_recently_hour_boundaries(spark):
    last = T(2024, 7, 1, 10, 59)
    r = runs_df(spark, [("x", dt.date(2024, 7, 1), "terminations", 1, None, "SUCCESS",
                         T(2024, 7, 1, 10), last, None)])
    # 11:59 next day: 25 hour boundaries crossed -> not stale; 12:00 -> 26 -> stale
    assert RN.ran_recently(r, "2024-07-02 11:59:00").count() == 0
    stale = RN.ran_recently(r, "2024-07-02 12:00:00").first()
    assert stale.hours_since_last_run == 26
    assert RN.ran_recently(runs_df(spark, []), "2024-07-02 12:00:00").count() == 1


def test_operational_queries(spark):
    d = dt.date
    r = runs_df(spark, [row("terminations", d(2024, 6, 1), n=3), row("terminations", d(2024, 6, 1), n=4),
                        row("pipeline", d(2024, 6, 28), "FAILED", n=0), row("employees", d(2024, 5, 1))])
    assert [tuple(x) for x in RN.daily_volume(r).collect()] == [(d(2024, 6, 1), 7)]
    assert [x.entity for x in RN.last_success(r).collect()] == ["employees", "terminations"]
    assert RN.failed_runs(r, "2024-07-01").count() == 1
    h = RN.run_history(r, "2024-07-01").collect()
    assert len(h) == 3 and h[0].duration_seconds == 300


def test_record_run_and_read(spark, tmp_path):
    p = str(tmp_path / "runs")
    rid = RN.record_run(spark, p, "employees", "2024-07-01", 12, "SUCCESS", T(2024, 7, 1, 2), keys=["a", "b"])
    got = RN.read_runs(spark, p).first()
    assert got.run_id == rid and got.records_staged == 12 and got.s3_key == '["a", "b"]'


def test_validate_window():
    FL.validate_window("2024-01-01", "2024-02-01", as_of="2024-03-01", status="All", termination_type="Voluntary")
    for kw in [dict(start="2024-03-02", as_of="2024-03-01"), dict(end="2024-03-02", as_of="2024-03-01"),
               dict(start="2024-02-02", end="2024-02-01", as_of="2024-03-01"), dict(status="active"),
               dict(termination_type="voluntary")]:
        with pytest.raises(ValueError):
            FL.validate_window(**kw)


def test_page_limit_zero_means_all(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert FL.page(df, ["k"], limit=0, offset=0).count() == 10
    assert [r.k for r in FL.page(df, ["k"], limit=3, offset=4).collect()] == [4, 5, 6]


def test_adjacent_pages_neither_repeat_nor_miss_rows(spark):
    rows = [(None if i % 5 == 0 else i % 7, i) for i in range(230)] * 2
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for size in (1, 37, 100):
        if size == 1:
            got = [tuple(FL.page(df, ["k"], limit=1, offset=o).first()) for o in (0, 5, 459)]
            assert got == [want[o] for o in (0, 5, 459)]
        else:
            got = [tuple(r) for o in range(0, 460, size) for r in FL.page(df, ["k"], limit=size, offset=o).collect()]
            assert got == want
    assert [tuple(r) for r in FL.page(df, ["k"], limit=0, offset=400).collect()] == want[400:]


def test_lookback_days_reopens_recent_days(spark):
    d = dt.date
    r = runs_df(spark, [row("terminations", d(2024, 6, 30))])
    w = RN.resolve_window(r, "2024-07-01", lookback_days=3).first()
    assert (w.start_date, w.end_date) == (d(2024, 6, 28), d(2024, 7, 1))


def test_nightly_run_with_load_confirmation(spark, tmp_path):
    from pyspark.sql import functions as F
    import seed
    from attrix.plans.nightly import run_ingest
    from attrix.sources.landing import api_records
    from attrix.streaming.ingest import read_raw
    emp = api_records(seed.raw_employees(spark), "employees")
    term = api_records(seed.raw_terminations(spark), "terminations")
    b = str(tmp_path)
    conf = {"raw": f"{b}/raw", "history": f"{b}/hist", "checkpoint": f"{b}/ckpt"}
    out = run_ingest(spark, emp, term, f"{b}/landing", f"{b}/runs", run_date="2025-04-01",
                     full_load=True, confirm_with=conf)
    n = len(seed.TERMINATIONS)
    assert out["employees"]["records"] == len(seed.EMPLOYEES) and out["terminations"]["records"] == n
    assert read_raw(spark, f"{b}/raw/terminations", "terminations").count() == n
    runs = RN.read_runs(spark, f"{b}/runs")
    assert runs.where(F.col("status") == "SUCCESS").count() == 2
    # a failing run is logged as entity 'pipeline' and re-raised
    with pytest.raises(ValueError):
        run_ingest(spark, emp, term, f"{b}/landing", f"{b}/runs", run_date="2025-04-01",
                   start_date="2025-05-01", as_of="2025-04-01")
    failed = RN.read_runs(spark, f"{b}/runs").where("status = 'FAILED'").first()
    assert failed.entity == "pipeline" and "lies after" in failed.error_message


def test_a_run_whose_load_is_lost_fails(spark, tmp_path, monkeypatch):
    """A second run of one day is not confirmed by what the first one loaded."""
    import seed
    from attrix.plans.nightly import run_ingest
    from attrix.sources.landing import api_records
    from attrix.streaming import ingest as I
    emp = api_records(seed.raw_employees(spark), "employees")
    term = api_records(seed.raw_terminations(spark), "terminations")
    b = str(tmp_path)
    conf = {"raw": f"{b}/raw", "history": f"{b}/hist", "checkpoint": f"{b}/ckpt"}
    args = (spark, emp, term, f"{b}/landing", f"{b}/runs")
    run_ingest(*args, run_date="2025-04-01", full_load=True, confirm_with=conf)

    class Nothing:
        def awaitTermination(self):
            pass
    monkeypatch.setattr(I, "ingest_stream", lambda *a, **k: Nothing())
    with pytest.raises(RuntimeError, match="confirms 0"):
        run_ingest(*args, run_date="2025-04-01", full_load=True, confirm_with=conf)
    log = RN.read_runs(spark, f"{b}/runs").where("status = 'FAILED'").first()
    assert log.entity == "pipeline" and "confirms 0" in log.error_message


def test_error_text_is_kept_whole(spark, tmp_path):
    p = str(tmp_path / "runs")
    RN.record_run(spark, p, "pipeline", "2024-07-01", 0, "FAILED", T(2024, 7, 1, 2), error_message="x" * 50_000)
    assert len(RN.read_runs(spark, p).first().error_message) == 50_000
