"""The turnover mart, kept up to date by what a night changes.

A store (``attrix.sources.versioned``) holds the latest raw rows, each employee's exits, the
monthly deltas and the mart.  A night

1. merges its rows into the latest ones, reading only the buckets that they fall into;
2. takes the employees they concern, in the old version and in the new one, and subtracts
   what those counted for from what they count for now - a late, corrected or withdrawn
   exit is a difference like any other;
3. adds the difference to the stored (state, month) deltas;
4. recomputes each touched state's months from the first one that changed, with the stored
   headcount before it as a starting value and the stored rows before it as window lead-in.

Steps 3 and 4 work on tables of groups x months rows.  One commit makes all of it current,
so a night that fails halfway has not happened, and a night that runs twice changes nothing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from attrix.functions import as_date, clean_upper, days_between, flag, month_start, surrogate_key
from attrix.operators.headcount import (EXIT_COUNTS, headcount_deltas, headcount_from_deltas, headcount_rows, monthly_combined,
                                        monthly_exits)
from attrix.operators.rolling import rolling_turnover
from attrix.plans.staging import ORDER
from attrix.schema import REGRETTABLE_MIN_TENURE_DAYS, ROLLING_MONTHS, SPINE_START
from attrix.sources.versioned import Snapshot, Store

_COUNTS = ["dn", "dk", *EXIT_COUNTS]
GROUP = "location_state"


def _month_before(as_of) -> _dt.date:
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
    return (day.replace(day=1) - _dt.timedelta(days=1)).replace(day=1)


def contributions(employees: DataFrame, exits: DataFrame, spine_start=SPINE_START, keep=lambda df, name: df) -> DataFrame:
    """(g, m, dn, dk, exit counts): what latest employee rows and their exits add to each state and month.

    The sum over all employees is the mart's whole input; that of some employees is their part.
    ``keep`` may store the two tables that are read more than once.
    """
    dim = keep(employees.select("employee_key", clean_upper(GROUP).alias(GROUP), "hire_date"), "part-employees")
    known = dim.select(F.col("employee_key").alias("_ek"), GROUP, "hire_date")
    voluntary = flag(clean_upper("termination_type") == F.lit("VOLUNTARY"))
    fct = exits.join(known, exits["employee_key"] == known["_ek"], "left").select(
        "employee_key", GROUP, "hire_date", "termination_date", voluntary.alias("is_voluntary"),
        flag(voluntary & F.col("hire_date").isNotNull()
             & (days_between("hire_date", "termination_date") >= REGRETTABLE_MIN_TENURE_DAYS)).alias("is_regrettable"))
    fct = keep(fct, "part-exits")
    deltas = headcount_deltas(headcount_rows(dim, fct), month_start(as_date(spine_start)), weight="weight")
    left = monthly_exits(fct).withColumnsRenamed({GROUP: "g", "month_start": "m"})
    zero = F.lit(0).cast("long")
    return (deltas.select("g", "m", "dn", "dk", *[zero.alias(c) for c in EXIT_COUNTS])
            .unionByName(left.select("g", "m", zero.alias("dn"), zero.alias("dk"), *EXIT_COUNTS)))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("g", "m").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _exits(terminations: DataFrame) -> DataFrame:
    return terminations.select(surrogate_key("employee_id").alias("employee_key"), "termination_id", "termination_date", "termination_type")


def update_mart(store: Store, employees: DataFrame, terminations: DataFrame, as_of, spine_start=SPINE_START,
                months: int = ROLLING_MONTHS, buckets: int = 64) -> int:
    """Apply a night's raw rows to the store and make the new version current; returns it.

    Afterwards the table ``turnover`` equals ``turnover_mart`` over all rows of all nights.
    Rows may come late, repeat, or correct earlier ones; an exit whose latest row has no date is
    withdrawn.  ``spine_start`` and ``months`` are fixed by the first night; ``as_of`` may not go back a month.
    """
    tx = store.begin()
    keyed = employees.withColumn("employee_key", surrogate_key("employee_id"))
    emp = tx.merge("employees", keyed, ["employee_key"], ORDER["employees"], buckets)
    term = tx.merge("terminations", terminations, ["termination_id"], ORDER["terminations"], buckets)

    # the same terminations by employee: rows leave where they were and enter where they are now
    come = tx.keep(_exits(term.after()), "exits-now")
    gone = tx.keep(_exits(term.before()) if term.before() is not None else come.limit(0), "exits-before")
    moved = come.select("employee_key").union(gone.select("employee_key")).distinct()
    if "exits" in tx.base:
        touched = tx.base.touched("exits", moved)
        stays = tx.base.read("exits", touched)
        same = stays["employee_key"].eqNullSafe(gone["employee_key"]) & stays["termination_id"].eqNullSafe(gone["termination_id"])
        tx.replace("exits", stays.join(gone, same, "left_anti").unionByName(come), ["employee_key"], touched)
    else:
        tx.replace("exits", come, ["employee_key"], buckets=buckets)

    concerned = tx.keep(emp.keys.union(moved).distinct(), "concerned")
    around = tx.now.touched("employees", concerned)

    def part(snapshot: Snapshot) -> DataFrame:
        rows = [snapshot.read(name, around).join(concerned, "employee_key", "left_semi") for name in ("employees", "exits")]
        return contributions(*rows, spine_start, tx.keep)

    change = part(tx.now)
    if "deltas" in tx.base:
        back = part(tx.base)
        change = change.unionByName(back.select("g", "m", *[(-F.col(c)).alias(c) for c in _COUNTS]))
    change = tx.keep(_summed(change).where(" or ".join(f"{c} <> 0" for c in _COUNTS)), "change")
    if "deltas" in tx.base:
        touched = tx.base.touched("deltas", change.select("g"))
        tx.replace("deltas", _summed(tx.base.read("deltas", touched).unionByName(change)), ["g"], touched)
    else:
        tx.replace("deltas", change, ["g"], buckets=8)

    _update_turnover(tx, change, _month_before(as_of), _dt.date.fromisoformat(str(spine_start)[:10]).replace(day=1), months)
    version = tx.commit()
    tx.done()
    return version


def _update_turnover(tx, change: DataFrame, last: _dt.date, first: _dt.date, months: int) -> None:
    settings = {"until": str(last), "from": str(first), "months": months}
    start = change.where(F.col("m") >= F.lit(first)).groupBy("g").agg(F.min("m").alias("m0"))
    touched = old = None
    if "turnover" in tx.base:
        was = tx.base.tables["turnover"]["settings"]
        if was | {"until": 0} != settings | {"until": 0} or str(last) < was["until"]:
            raise ValueError(f"the stored mart has {was}, not {settings}")
        if str(last) > was["until"]:        # new months for every group, changed or not
            after = F.add_months(F.lit(was["until"]).cast("date"), 1)
            every = tx.now.read("deltas").select("g").distinct().withColumn("m0", after)
            start = start.unionByName(every).groupBy("g").agg(F.min("m0").alias("m0"))
        else:
            touched = tx.base.touched("turnover", start.select(F.col("g").alias(GROUP)))
        old = tx.base.read("turnover", touched)
    deltas = tx.now.read("deltas").alias("d")
    start = start.withColumnRenamed("g", "g0")
    mine = deltas.join(start, F.col("g").eqNullSafe(F.col("g0")))
    # what came before the first changed month is one starting value there
    folded = _summed(mine.withColumn("m", F.greatest("m", "m0"))).where(F.col("m") <= F.lit(last)).select("g", "m", "dn", "dk")
    exits = mine.where((F.col("m") >= F.col("m0")) & (F.col("m") <= F.lit(last))).select(
        F.col("m").alias("month_start"), F.col("g").alias(GROUP), *EXIT_COUNTS)
    monthly = monthly_combined(headcount_from_deltas(folded, F.lit(last)), exits)
    rows = monthly.withColumn("new", F.lit(True))
    stays = None
    if old is not None:
        old = old.join(start, F.col(GROUP).eqNullSafe(F.col("g0")), "left")
        stays = old.where(F.col("m0").isNull() | (F.col("month_start") < F.col("m0"))).drop("g0", "m0")
        lead = old.where(F.col("month_start") < F.col("m0")).withColumn(
            "_n", F.row_number().over(Window.partitionBy(GROUP).orderBy(F.desc("month_start")))).where(F.col("_n") < months)
        rows = rows.unionByName(lead.select(*monthly.columns, F.lit(False).alias("new")))
    fresh = rolling_turnover(rows, months=months)
    if stays is not None:
        fresh = (fresh.join(rows.where("new").select(F.col("month_start").alias("_m"), F.col(GROUP).alias("_g")),
                            (F.col("month_start") == F.col("_m")) & F.col(GROUP).eqNullSafe(F.col("_g")), "left_semi")
                 .unionByName(stays))
    tx.replace("turnover", fresh, [GROUP], touched, buckets=8)
    tx.now.tables["turnover"]["settings"] = settings


def read_mart(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return Store(spark, path).snapshot(version).read("turnover")
