"""Checks by changed buckets against the checks of all rows."""

import datetime as dt
import random

import pytest

from attrix.operators.quality import Check, run_suite
from attrix.plans import check_state as S
from attrix.sources import versioned as V

PARENT, CHILD = "k string, status string, born date, day date", "id string, k string, n int"
CHECKS = [
    Check("parent", "k", "unique"), Check("parent", "status", "unique"), Check("parent", "k", "not_null"),
    Check("parent", "status", "accepted_values", {"values": ["A", "B"]}, "warn"), Check("parent", "day", "not_in_future", {"as_of": "2020-01-20"}),
    Check("parent", "day", "not_before_column", {"reference_column": "born"}),
    Check("child", "k", "relationships", {"to": "parent", "field": "k"}), Check("child", "n", "is_between", {"min_value": 2, "max_value": 6}),
    Check("child", "n", "not_null", severity="warn"),
]


def night(rng):
    day = lambda: rng.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 40))])
    parent = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, *"ABCD"]), day(), day()) for _ in range(rng.choice([0, 3, 12]))]
    child = [(f"c{rng.randint(0, 20)}", rng.choice([None, *"abcdefghxyz"]), rng.choice([None, *range(9)])) for _ in range(rng.choice([0, 4, 15]))]
    return parent, child


def apply(spark, store, parent, child):
    tx = store.begin()
    tx.merge("parent", spark.createDataFrame(parent, PARENT), ["k"], ["day"], buckets=5)
    tx.merge("child", spark.createDataFrame(child, CHILD), ["id"], ["n"], buckets=5)
    tx.commit()
    tx.done()


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed", [1])
def test_each_night_equals_the_full_suite(spark, tmp_path, seed):
    rng, store = random.Random(seed), V.Store(spark, str(tmp_path / "s"))
    for i in range(3):
        apply(spark, store, *night(rng))
        as_of = f"2020-01-{20 + i}"
        checks = [Check(c.model, c.column, c.test, {"as_of": as_of}, c.severity) if c.test == "not_in_future" else c for c in CHECKS]
        got = S.update_checks(store, checks, as_of, buckets=7)
        now = store.snapshot()
        assert rows(got) == rows(run_suite(checks, {m: now.read(m) for m in ("parent", "child")}))
    version = now.version
    assert rows(S.update_checks(store, checks, as_of)) == rows(got) and store.snapshot().version == version    # nothing changed
    later = S.update_checks(store, [Check(c.model, c.column, c.test, {"as_of": "2021-01-01"}, c.severity) if c.test == "not_in_future" else c
                                    for c in CHECKS], "2021-01-01")
    assert next(r["failures"] for r in later.collect() if r["test"].startswith("not_in_future")) == 0
    with pytest.raises(ValueError):
        S.update_checks(store, CHECKS[:-1], as_of)


def test_a_night_counts_changed_buckets_only(spark, tmp_path, monkeypatch):
    store = V.Store(spark, str(tmp_path / "s"))
    apply(spark, store, [(f"k{i}", "A", None, dt.date(2020, 1, 1)) for i in range(200)], [(f"c{i}", f"k{i}", 3) for i in range(200)])
    S.update_checks(store, CHECKS, "2020-01-20")
    apply(spark, store, [("k5", "Z", None, None)], [("c9", "nobody", 5)])
    seen, real = [], S.check_counts

    def spy(models, checks):
        seen.append({m: len(df.inputFiles()) for m, df in models.items()})
        return real(models, checks)
    monkeypatch.setattr(S, "check_counts", spy)
    failures = {r["test"]: r["failures"] for r in S.update_checks(store, CHECKS, "2020-01-20").collect()}
    assert len(seen) == 2 and all(n == 1 for s in seen for n in s.values())        # one bucket each, new and old
    assert failures["accepted_values_parent_status"] == 1 and failures["relationships_child_k"] == 1
