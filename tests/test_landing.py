import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from attrix.schema import API_EMPLOYEE, API_TERMINATION
from attrix.session import bare_path
from attrix.sources import landing as L
from attrix.streaming import ingest as I


def api_emps(spark, n, start=0):
    rows = [(f"EMP-{i:06d}", "A", "B", "a@b", "t", "d", "c", "st", "US", "2020-01-15",
             "Active", "Employee", None) for i in range(start, start + n)]
    return spark.createDataFrame(rows, API_EMPLOYEE)


def test_pages_of_500(spark, tmp_path):
    for n, pages in [(500, 1), (501, 2), (1000, 2), (1001, 3)]:
        base = str(tmp_path / f"l{n}")
        s = L.stage(api_emps(spark, n), "employees", "2024-07-01", base, records_per_file=500)
        assert (s["records"], s["pages"]) == (n, pages)
        df = L.read_landing(spark, base, "employees")
        counts = {r["_pipeline_page_num"]: r["count"] for r in df.groupBy("_pipeline_page_num").count().collect()}
        assert sorted(counts) == list(range(pages))
        assert all(c == 500 for p, c in counts.items() if p < pages - 1)
        # pages follow the natural key order
        first = df.where("_pipeline_page_num = 0").agg(F.max("employee_id")).first()[0]
        assert first == f"EMP-{min(n, 500) - 1:06d}"
        # each file holds at most one page worth of rows
        assert all(c <= 500 for c in df.groupBy(F.input_file_name()).count().toPandas()["count"])


def test_empty_input_writes_nothing(spark, tmp_path):
    s = L.stage(api_emps(spark, 0), "employees", "2024-07-01", str(tmp_path / "e"))
    assert s == {"entity": "employees", "run_date": "2024-07-01", "records": 0, "pages": 0, "dates_lost": 0,
                 "path": None, "files": []}


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("1", "2024-13-45"), ("2", "2024-02-29"), ("3", None)], "id string, hire_date string")
    got = {r.id: r.hire_date for r in L.coerce_dates(df).collect()}
    assert got == {"1": None, "2": dt.date(2024, 2, 29), "3": None}


def test_report_json_roundtrip(spark, tmp_path):
    rec = {"termination_id": "X7", "employee_id": "P41", "termination_date": "2023-02-28",
           "last_day_of_work": "2023-02-20", "termination_type": "Involuntary",
           "termination_reason": "Layoff", "termination_reason_detail": "site closed",
           "rehire_eligible": False, "recorded_by": "desk 4", "recorded_at": "2023-03-02T17:40:05Z"}
    env = {"report_name": "Leavers", "generated_at": "2023-04-01T00:30:00Z", "tenant": "north",
           "total_records": 7, "data": [rec, dict(rec, termination_id="X8")]}
    p = tmp_path / "r.json"
    p.write_text(json.dumps(env, indent=2))
    recs = L.read_report_json(spark, str(p), API_TERMINATION)
    assert recs.count() == 2
    raw = L.to_raw(L.coerce_dates(recs), "terminations").first()
    assert raw.recorded_at == dt.datetime(2023, 3, 2, 17, 40, 5) and raw.termination_date == dt.date(2023, 2, 28)


def test_broken_report_fails_the_read(spark, tmp_path):
    ok = {"report_name": "r", "data": [{"termination_id": "X1"}]}
    for i, bad in enumerate(['{"report_name": "r", "data": [{"termination_id": "X', '{"report_name": "r"}', "plain text"]):
        p = tmp_path / f"r{i}"
        p.mkdir()
        (p / "a.json").write_text(json.dumps(ok))
        (p / "b.json").write_text(bad)
        with pytest.raises(Exception, match="unreadable report envelope"):
            L.read_report_json(spark, str(p), API_TERMINATION).collect()


def test_date_times_parse_and_losses_are_counted(spark, tmp_path):
    forms = {"2024-07-01": dt.date(2024, 7, 1), "2024-07-01T00:00:00Z": dt.date(2024, 7, 1), "2024-07-01 09:00:00": dt.date(2024, 7, 1),
             "2024-07-01T23:30:00-05:00": dt.date(2024, 7, 1), " 2024-07-01 ": dt.date(2024, 7, 1), "01.07.2024": None,
             "2024-07-01T99:00": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "hire_date string").withColumn("t", F.col("hire_date"))
    assert {r.t: r.hire_date for r in L.coerce_dates(df).collect()} == forms
    assert df.agg(F.sum(L.lost_dates(df))).first()[0] == 3
    emps = api_emps(spark, 4).withColumn("hire_date", F.when(F.col("employee_id") == "EMP-000002", "soon").otherwise(F.col("hire_date")))
    s = L.stage(emps, "employees", "2024-07-01", str(tmp_path / "l"))
    assert s["dates_lost"] == 1 and s["records"] == 4
    assert sorted(bare_path(f) for f in s["files"]) == sorted(str(p) for p in (tmp_path / "l").rglob("*.parquet"))
    again = L.stage(emps, "employees", "2024-07-01", str(tmp_path / "l"))
    assert not set(again["files"]) & set(s["files"])


def test_new_checkpoint_adds_to_the_raw_table(spark, tmp_path):
    out = str(tmp_path / "out dir")
    for i in range(2):
        L.stage(api_emps(spark, 5, start=10 * i), "employees", "2024-07-01", str(tmp_path / f"land {i}"))
        for _ in range(2):      # a restart of the same stream adds nothing
            I.ingest_stream(spark, str(tmp_path / f"land {i}"), "employees", f"{out}/raw", f"{out}/hist", f"{out}/c{i}").awaitTermination()
    assert I.read_raw(spark, f"{out}/raw", "employees").count() == 10
    h = I.read_history(spark, f"{out}/hist")
    assert h.agg(F.sum("row_count")).first()[0] == 10
    assert h.where("file_size is null or file_size = 0").count() == 0 and h.select("_stream_id").distinct().count() == 2


def test_other_errors_fail_the_batch(spark, tmp_path, monkeypatch):
    """A storage error is not a bad file: the batch fails, and the next run reads the file."""
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")
    L.stage(api_emps(spark, 5), "employees", "2024-07-01", base)
    real = I._declared

    def broken(*a):
        raise OSError("storage is away")
    monkeypatch.setattr(I, "_declared", broken)
    with pytest.raises(Exception, match="storage is away"):
        I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
    monkeypatch.setattr(I, "_declared", real)
    I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
    assert I.read_raw(spark, f"{out}/raw", "employees").count() == 5


def test_ingest_is_exactly_once_per_file(spark, tmp_path):
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")

    def run():
        I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
        return I.read_raw(spark, f"{out}/raw", "employees").count()

    L.stage(api_emps(spark, 700), "employees", "2024-07-01", base)
    assert run() == 700
    assert run() == 700                       # nothing new: nothing added
    L.stage(api_emps(spark, 10, start=700), "employees", "2024-07-02", base)
    assert run() == 710                       # a new file adds only its rows
    hist = I.read_history(spark, f"{out}/hist")
    assert hist.agg(F.sum("row_count")).first()[0] == 710
    assert {r.status for r in hist.collect()} == {"LOADED"}
    assert I.load_failures(hist, dt.datetime.now()).count() == 0


def test_all_null_column_page_is_typed(spark, tmp_path):
    # manager_id null throughout a page: our stager still writes the declared string type
    base = str(tmp_path / "n")
    L.stage(api_emps(spark, 3), "employees", "2024-07-01", base)
    df = L.read_landing(spark, base, "employees")
    assert dict(df.dtypes)["manager_id"] == "string" and df.where("manager_id is null").count() == 3


def test_foreign_files_load_or_fail_per_file(spark, tmp_path):
    """A page whose all-null column has another physical type still loads; garbage is LOAD_FAILED."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    base, out = tmp_path / "landing", str(tmp_path / "out")
    L.stage(api_emps(spark, 5), "employees", "2024-07-01", str(base))
    day = base / "employees" / "year=2024" / "month=07" / "day=02"
    day.mkdir(parents=True)
    cols = {f.name: [None] * 2 for f in API_EMPLOYEE.fields}
    cols["employee_id"] = ["EMP-X1", "EMP-X2"]
    cols["hire_date"] = [dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    tbl = pa.table({**cols, "manager_id": pa.array([None, None], pa.int32()),
                    "_pipeline_entity": ["employees"] * 2,
                    "_pipeline_run_date": [dt.date(2024, 7, 2)] * 2,
                    "_pipeline_page_num": pa.array([0, 0], pa.int64()),
                    "_pipeline_written_at": [dt.datetime(2024, 7, 2, 2)] * 2})
    pq.write_table(tbl, day / "foreign_p000.parquet")
    (day / "broken_p001.parquet").write_bytes(b"not a parquet file at all")
    I.ingest_stream(spark, str(base), "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
    raw = I.read_raw(spark, f"{out}/raw", "employees")
    assert raw.count() == 7
    assert raw.where("employee_id = 'EMP-X1'").first().hire_date == dt.date(2020, 1, 1)
    hist = {r.file_name.rsplit("/", 1)[-1]: r for r in I.read_history(spark, f"{out}/hist").collect()}
    assert hist["broken_p001.parquet"].status == "LOAD_FAILED"
    assert hist["foreign_p000.parquet"].row_count == 2
    assert I.load_failures(I.read_history(spark, f"{out}/hist"), dt.datetime.now()).count() == 1


def test_landing_date_window_prunes_partitions(spark, tmp_path):
    base = str(tmp_path / "p")
    for d in ["2024-07-01", "2024-07-02", "2024-08-01"]:
        L.stage(api_emps(spark, 10), "employees", d, base)
    df = L.read_landing(spark, base, "employees", "2024-07-02", "2024-07-31")
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "make_date" in plan


def test_row_index_splits_a_hot_key(spark):
    rows = [("HOT", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(4)
    idx = L.with_row_index(df, ["k"], "ix", partitions=8)
    per_part = idx.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in per_part) < 3000          # the hot key spans partitions
    got = [tuple(r) for r in idx.orderBy("ix").collect()]
    assert [r[2] for r in got] == list(range(9000))          # contiguous
    assert [(r[0], r[1]) for r in got] == sorted(rows)       # in total order


def test_many_small_batches_load_everything_once(spark, tmp_path):
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for d in ["2024-07-01", "2024-07-02", "2024-07-03"]:
        L.stage(api_emps(spark, 30), "employees", d, base, records_per_file=10)
    I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt",
                    max_files_per_trigger=2).awaitTermination()
    raw = I.read_raw(spark, f"{out}/raw", "employees")
    assert raw.count() == 90
    assert I.read_history(spark, f"{out}/hist").select("_batch_id").distinct().count() >= 4


def test_queries_pin_utc_session_time(spark):
    import __spark_entry__ as E
    import oracle
    from conftest import SF_SMALL
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    df = E.queries()["ingest_stream"](spark, SF_SMALL)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert oracle.compare(df, E.oracle_sql()["ingest_stream"], oracle.duck(SF_SMALL))["ok"]


def test_lost_cast_values_are_reported_per_column(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    base, out = tmp_path / "landing", str(tmp_path / "out")
    day = base / "terminations" / "year=2024" / "month=07" / "day=01"
    day.mkdir(parents=True)
    cols = {f.name: [None, None] for f in API_TERMINATION.fields}
    cols.update(termination_id=["T1", "T2"], employee_id=["E1", "E2"],
                recorded_at=["2024-07-01T09:15:00Z", "not a time"])
    tbl = pa.table({**cols, "termination_date": pa.array([dt.date(2024, 6, 30)] * 2),
                    "last_day_of_work": pa.array([dt.date(2024, 6, 30)] * 2),
                    "rehire_eligible": pa.array([True, False]),
                    "_pipeline_entity": ["terminations"] * 2,
                    "_pipeline_run_date": [dt.date(2024, 7, 1)] * 2,
                    "_pipeline_page_num": pa.array([0, 0], pa.int64()),
                    "_pipeline_written_at": [dt.datetime(2024, 7, 1, 2)] * 2})
    pq.write_table(tbl, day / "p000.parquet")
    I.ingest_stream(spark, str(base), "terminations", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
    h = I.read_history(spark, f"{out}/hist").first()
    assert (h.status, h.row_parsed, h.row_count) == ("PARTIALLY_LOADED", 2, 2)   # both rows are in raw
    assert h.first_error_message == "values lost in cast: recorded_at=1"
    assert I.read_raw(spark, f"{out}/raw", "terminations").count() == 2      # rows kept, value null


def test_cluster_for_write_spreads_one_run_date(spark):
    rows = [(dt.date(2024, 7, 1), "ACTIVE", f"E{i:05d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "_pipeline_run_date date, employment_status string, employee_id string")
    out = L.cluster_for_write(df, ["_pipeline_run_date", "employment_status"], partitions=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000


def test_row_index_without_exchange_reuse(spark):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(5000).selectExpr("cast(id * 7919 % 5000 as string) AS k", "id").repartition(5)
        got = sorted(r.ix for r in L.with_row_index(df, ["k"], "ix", partitions=6).collect())
        assert got == list(range(5000))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
