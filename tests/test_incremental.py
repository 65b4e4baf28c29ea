"""The mart kept up to date night by night against the mart built from all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from attrix.plans import incremental as N
from attrix.plans.build import build
from attrix.schema import RAW
from attrix.sources import versioned as V

START = "2020-01-01"


def employee(i, state, hire, run, status="Active"):
    run_at = dt.datetime.combine(run, dt.time(2))
    row = dict.fromkeys((f.name for f in RAW["employees"].fields))
    return row | {"employee_id": i, "first_name": "A", "location_state": state, "hire_date": hire, "employment_status": status,
                  "_pipeline_run_date": run, "_pipeline_written_at": run_at, "_loaded_at": run_at}


def exit_(t, e, day, kind, run):
    run_at = dt.datetime.combine(run, dt.time(3))
    row = dict.fromkeys((f.name for f in RAW["terminations"].fields))
    return row | {"termination_id": t, "employee_id": e, "termination_date": day, "termination_type": kind,
                  "_pipeline_run_date": run, "_pipeline_written_at": run_at, "_loaded_at": run_at}


def frame(spark, rows, entity):
    names = [f.name for f in RAW[entity].fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW[entity])


def mart(df):
    return sorted(map(tuple, df.collect()), key=str)


def full(spark, emps, exits, as_of):
    return mart(build(frame(spark, emps, "employees"), frame(spark, exits, "terminations"), as_of, START)["turnover"])


def night_rows(rng, night):
    run = dt.date(2022, 1, 1) + dt.timedelta(days=40 * night)
    day = lambda: dt.date(2019, 6, 1) + dt.timedelta(days=rng.randint(0, 1200))
    ids = [None, *[f"E{i}" for i in range(40)]]
    emps = [employee(rng.choice(ids), rng.choice([" ny", "NY", "CA", "tx ", None]), rng.choice([None, *[day() for _ in range(9)]]), run)
            for _ in range(rng.choice([0, 3, 25]))]
    # records come back: with another date, without one, of another employee or type
    exits = [exit_(f"T{rng.randint(0, 25)}", rng.choice([*ids, "unknown"]), rng.choice([None, *[day() for _ in range(5)]]),
                   rng.choice(["Voluntary", "INVOLUNTARY", None]), run) for _ in range(rng.choice([0, 2, 20]))]
    return emps, exits


@pytest.mark.parametrize("seed", [1])
def test_every_night_equals_the_full_mart(spark, tmp_path, seed):
    rng, store = random.Random(seed), V.Store(spark, str(tmp_path / "store"))
    emps, exits = [], []
    for night in range(3):
        e, t = night_rows(rng, night)
        if night == 0:
            e += [employee(f"E{i}", "NY", dt.date(2020, 1, 1 + i), dt.date(2022, 1, 1)) for i in range(10)]
        emps, exits = emps + e, exits + t
        as_of = dt.date(2022, 9, 15) + dt.timedelta(days=31 * (night // 2))       # the month moves on every second night
        N.update_mart(store, frame(spark, e, "employees"), frame(spark, t, "terminations"), as_of, START, buckets=5)
        assert mart(N.read_mart(spark, store.path)) == full(spark, emps, exits, as_of)
    # the same night once more changes nothing
    before = mart(N.read_mart(spark, store.path))
    N.update_mart(store, frame(spark, e, "employees"), frame(spark, t, "terminations"), as_of, START, buckets=5)
    assert mart(N.read_mart(spark, store.path)) == before
    with pytest.raises(ValueError):
        N.update_mart(store, frame(spark, e, "employees"), frame(spark, t, "terminations"), "2022-01-01", START)


def test_late_corrected_moved_and_withdrawn_exits(spark, tmp_path):
    store = V.Store(spark, str(tmp_path / "store"))
    run = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    emps = [employee(f"E{i}", "NY" if i % 2 else "CA", dt.date(2020, 1, 5), run[0]) for i in range(8)]
    steps = [[exit_("T1", "E1", dt.date(2021, 3, 3), "voluntary", run[0])],
             [exit_("T2", "E3", dt.date(2020, 6, 6), "voluntary", run[1])],         # late: far back
             [exit_("T1", "E1", dt.date(2021, 8, 3), "voluntary", run[2])],         # corrected
             [exit_("T2", "E2", dt.date(2020, 6, 6), "layoff", run[3])],            # moved to an employee of another state
             [exit_("T1", "E1", None, "voluntary", run[4])]]                        # withdrawn
    seen = []
    for i, step in enumerate(steps):
        seen += step
        N.update_mart(store, frame(spark, emps if i == 0 else [], "employees"), frame(spark, step, "terminations"), "2022-01-10", START)
        got = N.read_mart(spark, store.path)
        assert mart(got) == full(spark, emps, seen, "2022-01-10")
    assert got.where("location_state = 'NY'").agg(F.sum("total_terminations")).first()[0] == 0


def test_a_night_reads_the_buckets_it_concerns_and_rewrites_its_states(spark, tmp_path, monkeypatch):
    store = V.Store(spark, str(tmp_path / "store"))
    run = dt.date(2022, 1, 1)
    emps = [employee(f"E{i}", f"S{i % 6}", dt.date(2020, 1, 5), run) for i in range(100)]
    N.update_mart(store, frame(spark, emps, "employees"), frame(spark, [], "terminations"), "2022-01-10", START, buckets=16)
    was = store.snapshot()
    read = []
    real = V.Snapshot.read

    def spy(self, name, buckets=None):
        read.append((name, None if buckets is None else len(list(buckets))))
        return real(self, name, buckets)
    monkeypatch.setattr(V.Snapshot, "read", spy)
    N.update_mart(store, frame(spark, [], "employees"), frame(spark, [exit_("T1", "E7", dt.date(2021, 2, 2), "x", run)], "terminations"),
                  "2022-01-10", START)
    assert all(n is not None and n <= 1 for name, n in read if name in ("employees", "exits", "terminations"))
    now = store.snapshot()
    assert now.tables["employees"]["folders"] == was.tables["employees"]["folders"]
    changed = [b for b, f in now.tables["turnover"]["folders"].items() if was.tables["turnover"]["folders"].get(b) != f]
    assert len(changed) == 1


def test_a_failed_night_has_not_happened(spark, tmp_path, monkeypatch):
    store = V.Store(spark, str(tmp_path / "store"))
    run = dt.date(2022, 1, 1)
    emps = frame(spark, [employee("E1", "NY", dt.date(2020, 1, 5), run)], "employees")
    N.update_mart(store, emps, frame(spark, [], "terminations"), "2022-01-10", START)
    before = mart(N.read_mart(spark, store.path))
    exits = frame(spark, [exit_("T1", "E1", dt.date(2021, 2, 2), "x", run)], "terminations")
    monkeypatch.setattr(N, "_update_turnover", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        N.update_mart(store, emps.limit(0), exits, "2022-01-10", START)
    monkeypatch.undo()
    assert store.versions() == [1] and mart(N.read_mart(spark, store.path)) == before
    N.update_mart(store, emps.limit(0), exits, "2022-01-10", START)
    assert mart(N.read_mart(spark, store.path)) != before


def test_what_a_part_reads_twice_may_be_stored(spark):
    day = dt.date(2020, 3, 1)
    emps = spark.createDataFrame([("k1", "ca", day), ("k2", None, day)], "employee_key string, location_state string, hire_date date")
    exits = spark.createDataFrame([("k1", "t1", dt.date(2023, 5, 2), "voluntary"), ("k9", "t2", day, "x")],
                                  "employee_key string, termination_id string, termination_date date, termination_type string")
    names = []

    def keep(df, name):
        names.append(name)
        return df
    plain, kept = N.contributions(emps, exits, START), N.contributions(emps, exits, START, keep)
    assert names == ["part-employees", "part-exits"] and sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))
