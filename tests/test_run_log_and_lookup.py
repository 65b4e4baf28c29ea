"""A run log that stays small, lookups that read nothing for an absent key, a stream that polls."""

import datetime as dt

from pyspark.sql import functions as F

from attrix.functions import surrogate_key
from attrix.operators import filters as FL, runs as RN
from attrix.plans.build import lookup_ready
from attrix.session import list_files
from attrix.sources import landing as L
from attrix.streaming import ingest as I
from test_landing import api_emps


def record(spark, path, i, status="SUCCESS"):
    RN.record_run(spark, path, "terminations", dt.date(2024, 1, 1) + dt.timedelta(days=i), i, status, dt.datetime(2024, 1, 1, 2))


def files(spark, path):
    import pathlib
    return [f for f in pathlib.Path(path).rglob("*.parquet")]


def test_the_log_stays_small_and_whole(spark, tmp_path):
    path, n = str(tmp_path / "runs"), 0
    assert RN.compact_runs(spark, path) == 0 and RN.read_runs(spark, path).count() == 0
    for night in range(5):
        for _ in range(2):
            record(spark, path, n)
            n += 1
        got = RN.compact_runs(spark, path)
        assert got == 2
        assert RN.read_runs(spark, path).count() == n
        assert RN.last_loaded_date(RN.read_runs(spark, path)).first()[0] == dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)
        assert len(files(spark, path)) <= 6 and len(list_files(spark, f"{path}/_compacted")) <= 2
    assert RN.compact_runs(spark, path) == 0                       # nothing new: nothing done
    assert [r["run_date"] for r in RN.read_runs(spark, path).orderBy("run_date").collect()] == [
        dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(n)]


def test_a_thousand_runs_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("run_id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("run_date"),
                                    F.lit("terminations").alias("entity"), F.col("id").alias("records_staged"), F.lit(None).cast("string").alias("s3_key"),
                                    F.lit("SUCCESS").alias("status"), F.lit("2020-01-01 02:00:00").cast("timestamp_ntz").alias("started_at"),
                                    F.lit("2020-01-01 03:00:00").cast("timestamp_ntz").alias("completed_at"), F.lit(None).cast("string").alias("error_message"))
    rows.repartition(1000, "run_id").write.mode("append").option("maxRecordsPerFile", 1).parquet(path)
    before = RN.last_loaded_date(spark.read.parquet(path)).first()[0]
    assert len(files(spark, path)) == 1000
    RN.compact_runs(spark, path)
    record(spark, path, 0, "FAILED")
    RN.compact_runs(spark, path)
    got = RN.read_runs(spark, path)
    assert len(files(spark, path)) <= 3 and got.count() == 1001 and RN.last_loaded_date(got).first()[0] == before


def test_records_appended_during_a_compaction_are_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    for i in range(3):
        record(spark, path, i)
    seen, real = [], RN.create_text

    def meanwhile(*a):
        record(spark, path, 3)                                    # written after the gathering has read its files
        seen.append(RN.read_runs(spark, path).count())
        done = real(*a)
        seen.append(RN.read_runs(spark, path).count())            # the gathered files are still there, and not read
        return done
    monkeypatch.setattr(RN, "create_text", meanwhile)
    assert RN.compact_runs(spark, path) == 3 and seen == [4, 4]
    monkeypatch.undo()
    assert RN.compact_runs(spark, path) == 1 and RN.read_runs(spark, path).count() == 4
    # of two at a time the slower gives up
    record(spark, path, 4)
    monkeypatch.setattr(RN, "create_text", lambda *a: False)
    assert RN.compact_runs(spark, path) == 0
    monkeypatch.undo()
    assert RN.read_runs(spark, path).count() == 5


# -- lookups ----------------------------------------------------------------------------

def rows_read(df):
    """Rows that the plan's scans put out, from Spark's own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_an_absent_key_reads_no_row_group(spark, tmp_path):
    n = 150_000       # more than a row group's dictionary holds: without a filter, only reading tells
    df = spark.range(n).coalesce(1).select(F.concat(F.lit("E"), "id").alias("employee_id"))
    df = df.select(surrogate_key("employee_id").alias("employee_key"), "employee_id")
    made = lookup_ready(spark, str(tmp_path), {"dim": "employee_key"}, files=1)("dim", df)
    assert made.count() == n and len(files(spark, str(tmp_path / "dim"))) == 1
    plain = lookup_ready(spark, str(tmp_path / "p"), {})("dim", df)
    for absent in ("E5x", "E123.4"):       # between those that are there
        q = FL.lookup(made, "employee_id", absent, hashed_key="employee_key")
        assert rows_read(q) == 0 and q.count() == 0
        assert rows_read(FL.lookup(plain, "employee_id", absent, hashed_key="employee_key")) > 0
    q = FL.lookup(made, "employee_id", "E77", hashed_key="employee_key")
    assert 0 < rows_read(q) < n // 2 and q.first()["employee_id"] == "E77"


# -- a stream that polls ------------------------------------------------------------------

def test_a_polling_stream_survives_a_stop_and_takes_late_files(spark, tmp_path):
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")

    def start():
        return I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt", available_now=False,
                               processing_time="0 seconds", max_files_per_trigger=1)
    L.stage(api_emps(spark, 60), "employees", "2024-07-01", base, records_per_file=20)
    first = start()
    while not list_files(spark, f"{out}/raw/_batches"):
        assert first.isActive
    first.stop()                                                   # somewhere in the next batches
    some = I.read_raw(spark, f"{out}/raw", "employees").count()
    assert 0 < some <= 60 and I.read_history(spark, f"{out}/hist").agg(F.sum("row_count")).first()[0] == some
    L.stage(api_emps(spark, 7, start=60), "employees", "2024-07-02", base)
    second = start()
    second.processAllAvailable()
    L.stage(api_emps(spark, 3, start=67), "employees", "2024-07-02", base)
    second.processAllAvailable()
    second.stop()
    raw = I.read_raw(spark, f"{out}/raw", "employees")
    assert raw.count() == 70 and raw.select("employee_id").distinct().count() == 70
    assert I.read_history(spark, f"{out}/hist").agg(F.sum("row_count")).first()[0] == 70



def test_continuous_ingest_takes_larger_batches_of_a_larger_landing(spark, monkeypatch):
    from attrix.plans import registry as R
    seen, stage, stream = [], R.stage, R.ingest_stream
    monkeypatch.setattr(R, "stage", lambda *a, **k: stage(*a, **k) | {"files": ["f"] * 400})
    monkeypatch.setattr(R, "ingest_stream", lambda *a, **k: seen.append(k["max_files_per_trigger"]) or stream(*a, **k))
    rows = R.q_ingest_continuous(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and seen == [100, 100]


def test_a_long_log_is_gathered_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(12):
        record(spark, path, i)
    size = sum(f.stat().st_size for f in files(spark, path))
    assert RN.compact_runs(spark, path, file_bytes=size // 4) == 12
    folder = [f for f in files(spark, path) if "_compacted_data" in str(f)]
    assert len(folder) >= 3
    assert sorted(r["records_staged"] for r in RN.read_runs(spark, path).collect()) == list(range(12))
