"""Pages by selection, Z-order clustering, windows checked per row, ingest batches that show whole or not at all."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from attrix.operators import filters as FL
from attrix.sources import landing as L
from attrix.streaming import ingest as I
from test_landing import api_emps


# -- pages ----------------------------------------------------------------------------

def table(spark, seed, n=3000):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", None, "a", "b" * 20 + str(rng.randint(0, 5))]) if rng.random() < 0.7 else rng.choice("xyz") * 8,
             rng.choice([None, 1.5, float("nan"), rng.random()]), rng.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 99))]),
             rng.randint(0, 50)) for _ in range(n)]
    return spark.createDataFrame(rows, "k string, x double, d date, n int")


@pytest.mark.parametrize("order", [["k"], ["d", "n"], ["x"]])
def test_pages_equal_a_full_sort(spark, monkeypatch, order):
    monkeypatch.setattr(FL._around, "__defaults__", (50,))       # cut down to small pieces
    df = table(spark, len(order))
    keys = [F.col(c).asc_nulls_last() for c in [*order, *[c for c in df.columns if c not in order]]]
    want = [str(tuple(r)) for r in df.orderBy(*keys).collect()]
    for offset, limit in ((0, 10), (1490, 25), (2990, 100), (3000, 5)):
        got = [str(tuple(r)) for r in FL.page(df, order, limit, offset).collect()]
        assert got == want[offset:offset + limit]
    assert [str(tuple(r)) for r in FL.page(df, order, None, 2500).collect()] == want[2500:]
    assert FL.page(df.limit(0), order, 5).count() == 0


def test_a_page_sorts_only_what_is_around_it(spark):
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_000).alias("n"), F.lit("x").alias("v"))
    kept, before = FL._around(df, ["n"], 250_000, 250_100)
    assert before <= 250_000 and kept.count() < 400_000 // 20
    assert [r["n"] for r in FL.page(df, ["n"], 100, 250_000).collect()] == list(range(250_000, 250_100))
    # a key that all rows hold: the next column cuts
    kept, _ = FL._around(df.select("v", "n"), ["v"], 250_000, 250_100)
    assert kept.count() < 400_000 // 20


# -- Z-order ----------------------------------------------------------------------------

def groups_read(path, column, low, high):
    """Share of rows in row groups whose statistics admit a value between ``low`` and ``high``."""
    read = total = 0
    for f in path.rglob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            at = next(i for i in range(group.num_columns) if group.column(i).path_in_schema == column)
            s = group.column(at).statistics
            total += group.num_rows
            read += group.num_rows if s.min <= high and s.max >= low else 0
    return read / total


def test_a_filter_on_either_column_skips_most_row_groups(spark, tmp_path):
    rng = random.Random(4)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.random() ** 3 * 900)), rng.choice("ABCDEFGH") + "x" * 5, i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "day date, kind string, i long").repartition(3)
    L.cluster_for_write(df, ["day", "kind"], partitions=64).write.parquet(str(tmp_path / "z"))
    assert groups_read(tmp_path / "z", "day", dt.date(2020, 3, 1), dt.date(2020, 3, 5)) < 0.3
    assert groups_read(tmp_path / "z", "kind", "Cxxxxx", "Cxxxxx") < 0.3
    back = spark.read.parquet(str(tmp_path / "z"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    # sorted on the first column alone, a filter on the second reads nearly everything
    df.repartitionByRange(64, "day", "kind").sortWithinPartitions("day", "kind").write.parquet(str(tmp_path / "s"))
    assert groups_read(tmp_path / "s", "kind", "Cxxxxx", "Cxxxxx") > 0.6


def test_one_value_still_spreads_over_tasks(spark):
    df = spark.range(5000).select(F.lit("2024-07-01").cast("date").alias("day"), F.when(F.col("id") % 2 == 0, "ACTIVE").alias("status"), "id")
    sizes = [r["n"] for r in L.cluster_for_write(df, ["day", "status"], partitions=8).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2000
    assert L.cluster_for_write(df.limit(0), ["day", "status"]).count() == 0


# -- windows ---------------------------------------------------------------------------

def test_window_problems_are_those_of_the_check(spark):
    d = dt.date
    rows = [(d(2024, 1, 1), d(2024, 1, 9), "Active", "Voluntary"), (d(2024, 1, 9), d(2024, 1, 1), None, None), (None, d(2030, 1, 1), "All", ""),
            (d(2031, 1, 1), d(2030, 1, 1), "nobody", "whim"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "start date, end date, status string, termination_type string, i int")
    got = {r["i"]: r["problems"] for r in FL.window_problems(df, "2024-06-30").collect()}
    for i, (a, b, s, t) in enumerate(rows):
        try:
            FL.validate_window(a, b, "2024-06-30", s, t)
            assert got[i] == []
        except ValueError as e:
            assert sorted(got[i]) == sorted(str(e).split("; "))
    assert [len(got[i]) for i in range(5)] == [0, 1, 1, 5, 0]


# -- ingest batches ----------------------------------------------------------------------

def test_a_batch_shows_in_both_tables_or_in_none(spark, tmp_path, monkeypatch):
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")

    def run():
        I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()

    def seen():
        return I.read_raw(spark, f"{out}/raw", "employees").count(), I.read_history(spark, f"{out}/hist").count()
    assert seen() == (0, 0)
    L.stage(api_emps(spark, 700), "employees", "2024-07-01", base)
    run()
    first = seen()
    assert first[0] == 700 and first[1] > 0
    L.stage(api_emps(spark, 10, start=700), "employees", "2024-07-02", base)
    for step in ("_history", "_finish"):          # between the two writes, and before the manifest
        with monkeypatch.context() as m:
            m.setattr(I, step, lambda *a: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(Exception, match="killed"):
                run()
        assert seen() == first
    run()
    assert seen()[0] == 710
    run()
    assert seen()[0] == 710


def test_the_landing_is_scanned_once(spark, tmp_path, monkeypatch):
    base, out = str(tmp_path / "landing"), str(tmp_path / "out")
    L.stage(api_emps(spark, 50), "employees", "2024-07-01", base)
    scans = []
    real = I._append

    def spy(df, *a):
        scans.append([f for f in df.inputFiles() if "/landing/" in f])
        return real(df, *a)
    monkeypatch.setattr(I, "_append", spy)
    I.ingest_stream(spark, base, "employees", f"{out}/raw", f"{out}/hist", f"{out}/ckpt").awaitTermination()
    assert len(scans) == 2 and scans[0] and not scans[1]


def test_a_page_near_the_top_is_one_pass(spark, monkeypatch):
    df = table(spark, 5)
    got = FL.page(df, ["k"], limit=20, offset=30)
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    top = [tuple(r) for r in got.collect()]
    monkeypatch.setattr(FL, "TOP_ROWS", 0)                       # the way of pages further down gives the same rows
    assert len(top) == 20 and list(map(str, top)) == [str(tuple(r)) for r in FL.page(df, ["k"], limit=20, offset=30).collect()]


def test_ranking_sorts_its_rows_once(spark):
    df = table(spark, 6).select("k", "n")
    ranked = L.with_row_index(df, ["k"], "i")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [k") == 1
    assert sorted(r["i"] for r in ranked.collect()) == list(range(df.count()))


def test_a_batch_is_written_without_sorting_by_its_partition(spark, tmp_path):
    raw = str(tmp_path / "raw")
    df = spark.range(5).select(F.col("id").cast("string").alias("x"))
    for n in (5, 3):                                             # a replay replaces the batch
        I._append(df.limit(n), "s", 7, raw)
    I._append(df, "s", 8, raw)
    got = spark.read.parquet(raw).groupBy(I.STREAM_COL, I.BATCH_COL).count().collect()
    assert sorted(map(tuple, got)) == [("s", 7, 3), ("s", 8, 5)]
