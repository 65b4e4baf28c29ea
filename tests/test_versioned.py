"""Tables changed by nightly merges: equal to a full recompute, only touched buckets rewritten, all or nothing."""

import random

import pytest
from pyspark.sql import functions as F

from attrix.operators.dedup import latest_per_key
from attrix.sources import versioned as V

SCHEMA = "k string, at int, v string"


def nights(seed, n=3):
    rng = random.Random(seed)
    keys = [None, *[f"k{i}" for i in range(30)]]
    return [[(rng.choice(keys), rng.choice([None, *range(6)]), rng.choice("abc")) for _ in range(rng.choice([0, 5, 60]))] for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_equal_a_full_recompute(spark, tmp_path, seed):
    store, seen = V.Store(spark, str(tmp_path / "store")), []
    for night in nights(seed):
        seen += night
        tx = store.begin()
        changes = tx.merge("t", spark.createDataFrame(night, SCHEMA), ["k"], ["at"], buckets=7)
        before = [] if changes.before() is None else rows(changes.before())
        assert tx.commit() == tx.base.version + 1
        after = rows(changes.after())
        assert {r[0] for r in after} == {r[0] for r in night} and {r[0] for r in before} <= {r[0] for r in night}
        tx.done()
        want = latest_per_key(spark.createDataFrame(seen, SCHEMA), ["k"], ["at"])
        assert rows(store.snapshot().read("t")) == rows(want)
    old = store.snapshot(1).read("t")                  # every version stays readable until it is removed
    assert rows(old) == rows(latest_per_key(spark.createDataFrame(nights(seed)[0], SCHEMA), ["k"], ["at"]))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = V.Store(spark, str(tmp_path / "store"))
    tx = store.begin()
    tx.merge("t", spark.range(1000).selectExpr("cast(id as string) as k", "1 as at", "'a' as v"), ["k"], ["at"], buckets=32)
    tx.commit()
    was = store.snapshot()
    tx = store.begin()
    tx.merge("t", spark.createDataFrame([("5", 2, "b"), ("5", 3, "c"), ("17", 0, "late")], SCHEMA), ["k"], ["at"])
    tx.commit()
    now = store.snapshot()
    touched = {str(b) for b in now.touched("t", spark.createDataFrame([("5",), ("17",)], "k string"))}
    folders = lambda s: s.tables["t"]["folders"]
    assert {b for b in folders(now) if folders(now)[b] != folders(was)[b]} == touched and len(touched) == 2
    assert rows(now.read("t").where("k in ('5', '17')")) == [("17", 1, "a"), ("5", 3, "c")]
    # a read of some buckets opens their files only
    files = now.read("t", [int(b) for b in touched]).inputFiles()
    assert files and all(any(f"{V.BUCKET}={b}/" in f for b in touched) for f in files)


def test_a_run_that_dies_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    store = V.Store(spark, str(tmp_path / "store"))
    tx = store.begin()
    tx.merge("t", spark.createDataFrame([("a", 1, "x")], SCHEMA), ["k"], ["at"])
    tx.commit()
    monkeypatch.setattr(V, "create_text", lambda *a: (_ for _ in ()).throw(OSError("power is out")))
    tx = store.begin()
    tx.merge("t", spark.createDataFrame([("a", 2, "y"), ("b", 1, "z")], SCHEMA), ["k"], ["at"])
    tx.replace("u", spark.createDataFrame([(1,)], "n int"), ["n"])
    with pytest.raises(OSError):
        tx.commit()
    monkeypatch.undo()
    assert store.versions() == [1] and "u" not in store.snapshot()
    assert rows(store.snapshot().read("t")) == [("a", 1, "x")]
    assert store.vacuum(1) == 2 and rows(store.snapshot().read("t")) == [("a", 1, "x")]


def test_the_second_of_two_transactions_fails(spark, tmp_path):
    store = V.Store(spark, str(tmp_path / "store"))
    one, two = store.begin(), store.begin()
    for tx, v in ((one, "x"), (two, "y")):
        tx.replace("t", spark.createDataFrame([("a", 1, v)], SCHEMA), ["k"])
    one.commit()
    with pytest.raises(V.Conflict):
        two.commit()
    assert rows(store.snapshot().read("t")) == [("a", 1, "x")]


def test_emptied_buckets_and_new_columns(spark, tmp_path):
    store = V.Store(spark, str(tmp_path / "store"))
    tx = store.begin()
    tx.replace("t", spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], SCHEMA), ["k"], buckets=50)
    tx.commit()
    tx = store.begin()
    gone = tx.base.touched("t", spark.createDataFrame([("a",)], "k string"))
    tx.replace("t", tx.base.read("t", gone).where("k <> 'a'"), ["k"], gone)
    tx.commit()
    assert rows(store.snapshot().read("t")) == [("b", 1, "y")]
    tx = store.begin()
    tx.merge("t", spark.createDataFrame([("c", 1, "z", 5)], SCHEMA + ", more int"), ["k"], ["at"])
    tx.commit()
    assert rows(store.snapshot().read("t")) == [("b", 1, "y", None), ("c", 1, "z", 5)]
    assert rows(store.snapshot().read("t", [])) == []


def test_a_hot_key_is_one_row_before_it_is_merged(spark, tmp_path):
    store = V.Store(spark, str(tmp_path / "store"))
    hot = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                     F.col("id").cast("int").alias("at"), F.lit("v").alias("v"))
    tx = store.begin()
    changes = tx.merge("t", hot, ["k"], ["at"])
    tx.commit()
    assert changes.keys.count() == store.snapshot().read("t").count() == 33_334


def test_scratch_tables_go_with_their_run(spark, tmp_path):
    from attrix.session import path_exists, scratch_path, scratch_run

    store = V.Store(spark, str(tmp_path / "store"))
    with pytest.raises(RuntimeError), scratch_run(spark) as run:
        tx = store.begin()
        tx.merge("t", spark.createDataFrame([("a", 1, "x")], SCHEMA), ["k"], ["at"])
        assert scratch_path(spark, "n").startswith(run) and path_exists(spark, run)
        tx.commit()
        raise RuntimeError
    assert not path_exists(spark, run) and not scratch_path(spark, "n").startswith(run)
    assert rows(store.snapshot().read("t")) == [("a", 1, "x")]


def test_a_grown_bucket_is_merged_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "PART_BYTES", 500)
    store = V.Store(spark, str(tmp_path / "store"))
    first = [(f"k{i}", 0, "a" * 50) for i in range(300)]
    later = [(f"k{i}", 1, "b") for i in range(0, 400, 2)]
    for night in (first, later):
        tx = store.begin()
        tx.merge("t", spark.createDataFrame(night, SCHEMA), ["k"], ["at"], buckets=2)
        tx.commit()
        tx.done()
    now = store.snapshot()
    assert len(now.read("t", [0]).inputFiles()) > 2
    assert rows(now.read("t")) == rows(latest_per_key(spark.createDataFrame(first + later, SCHEMA), ["k"], ["at"]))
