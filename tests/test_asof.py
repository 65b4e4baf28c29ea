"""As-of counts at any dates against the inequality join, and the spread of a hot group."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from attrix.operators.asof import asof_headcount, running_totals
from attrix.operators.headcount import month_spine, monthly_headcount
from test_headcount import LIFE, rand_rows


def brute(rows, dates):
    out = {}
    for d in dates:
        for k, g, a, b in rows:
            if a is not None and a <= d and (b is None or b > d):
                out[d, g] = out.get((d, g), 0) + (k is not None)
    return out


def got(df):
    return {(r["as_of_date"], r["location_state"]): r["headcount"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_dates_match_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = rand_rows(rng, 300)
    dates = [dt.date(2009, 1, 1) + dt.timedelta(days=rng.randint(0, 6000)) for _ in range(120)]
    dates += [r[2] for r in rows[:20] if r[2]] + [r[3] for r in rows[:20] if r[3]]      # the days of changes themselves
    spine = spark.createDataFrame([(d,) for d in [*dates, *dates[:5], None]], "day date")
    life = spark.createDataFrame(rows, LIFE)
    want = brute(rows, set(dates))
    assert got(asof_headcount(life, spine, "day")) == want
    dense = got(asof_headcount(life, spine, "day", dense=True))
    assert {k: v for k, v in dense.items() if k in want} == want and all(v == 0 for k, v in dense.items() if k not in want)
    assert asof_headcount(life, spine.limit(0), "day").count() == 0 == asof_headcount(life.limit(0), spine, "day").count()


def test_month_ends_equal_the_monthly_headcount(spark):
    life = spark.createDataFrame(rand_rows(random.Random(7), 300), LIFE)
    spine = month_spine(spark, dt.date(2015, 1, 1), dt.date(2019, 5, 1))
    monthly = monthly_headcount(life, dt.date(2015, 1, 1), dt.date(2019, 5, 1))
    want = {(r["month_end"], r["location_state"]): r["headcount"] for r in monthly.collect()}
    assert got(asof_headcount(life, spine, "month_end")) == want


def test_one_group_is_spread_over_tasks(spark, monkeypatch):
    """A single group's rows lie in several ranges, none of them large, and no plan pairs rows by nested loops."""
    from attrix.operators import asof as A

    tables = {}
    real = A._stored

    def spy(df, name):
        tables[name] = real(df, name)
        return tables[name]
    monkeypatch.setattr(A, "_stored", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # so small a table would be one range
    days = 6000
    life = spark.range(20_000).select(F.col("id").alias("employee_key"), F.lit("only").alias("location_state"),
                                      F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % days).cast("int")).alias("hire_date"),
                                      F.lit(None).cast("date").alias("termination_date"))
    spine = spark.range(0, days, 7).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    try:
        out = asof_headcount(life, spine, "day")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r["as_of_date"]: r["headcount"] for r in out.collect()} == {
        dt.date(2000, 1, 1) + dt.timedelta(days=d): 3 * (d + 1) + min(d + 1, 20_000 - 3 * days) for d in range(0, days, 7)}
    parts = [r["n"] for r in tables["ranged"].groupBy("_p").agg(F.count("*").alias("n")).collect()]
    assert len(parts) >= 4 and max(parts) < 0.5 * sum(parts)


def test_running_totals_are_exact_across_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(-5, 5)) for i in range(2000)]
    total, want = {}, {}
    for g, i, n in rows:
        total[g] = want[g, i] = total.get(g, 0) + n
    out = running_totals(spark.createDataFrame(rows, "g string, i int, n long"), "g", ["i"], ["n"])
    assert {(r["g"], r["i"]): r["n"] for r in out.collect()} == want
