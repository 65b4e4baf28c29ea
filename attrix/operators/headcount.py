"""Month spine, end-of-month headcount, monthly exits and their combination.

Headcount is an as-of range count: a lifecycle row (start, end) is counted in
month m when ``start <= last_day(m)`` and ``end`` is null or ``> last_day(m)``.
Because every comparison is against a month end this is the same as
``month(start) <= m < month(end)``: each row is active on a half-open interval
of months. Rather than pairing every row with every month (N × M pairs), each
row emits a +1 at its first counted month and a −1 at its exit month; a
partially-aggregated sum per (group, month) and a running sum per group give the
counts in O(N + groups × months) work, with no cross join and no row per pair.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from attrix.functions.dates import as_date, month_start


def _month() -> Column:
    return F.expr("INTERVAL 1 MONTH")


def _spine_bounds(spine_start, end_exclusive) -> tuple[Column, Column]:
    """(first month, last month) of a month spine that omits ``end_exclusive``'s month."""
    first = month_start(as_date(spine_start))
    last = F.add_months(month_start(as_date(end_exclusive)), -1)
    return first, last


def month_spine(spark: SparkSession, start, end_exclusive) -> DataFrame:
    """One row per month from ``start``'s month up to (not including) ``end_exclusive``'s.

    An empty range gives an empty frame (``sequence`` would raise on start > end).
    """
    first, last = _spine_bounds(start, end_exclusive)
    months = F.when(first <= last, F.sequence(first, last, _month())).otherwise(
        F.array().cast("array<date>"))
    return (spark.range(1).select(F.explode(months).alias("month_start"))
                 .select("month_start", F.last_day("month_start").alias("month_end")))


def monthly_headcount(life: DataFrame, spine_start, end_exclusive,
                      group: str = "location_state", key: str = "employee_key",
                      start: str = "hire_date", end: str = "termination_date",
                      dense: bool = False, weight: str | None = None) -> DataFrame:
    """End-of-month headcount per ``group`` over the month spine.

    ``weight`` names a column with how often a row counts (see ``headcount_rows``).

    Output ``(month_start, month_end, <group>, headcount)``; like the grouped
    count it reproduces, a (month, group) row exists only when at least one row
    is active, and ``headcount`` counts non-null keys. A null group is a group.
    ``dense=True`` keeps months with zero headcount after a group's first
    active month, so exits in a month that empties a group are still counted
    and trailing windows span calendar months.
    """
    first, last = _spine_bounds(spine_start, end_exclusive)
    deltas = headcount_deltas(life, first, last, group, key, start, end, weight)
    return headcount_from_deltas(deltas, last, group, dense)


def headcount_deltas(life: DataFrame, first: Column, last: Column | None = None, group: str = "location_state",
                     key: str = "employee_key", start: str = "hire_date", end: str = "termination_date",
                     weight: str | None = None) -> DataFrame:
    """``(g, m, dn, dk)``: change of the counted rows, and of those with a key, per group and month.

    Months before ``first`` count as ``first``; rows and months after ``last`` are left out, if given.
    Deltas of disjoint sets of rows add up, and those of a set of rows are taken back by their negative.
    """
    # first counted month (greatest() would skip a null hire date: keep it null)
    a = F.when(F.col(start).isNotNull(), F.greatest(month_start(start), first))
    b = month_start(end)                               # first month no longer counted
    k = F.when(F.col(key).isNotNull(), 1).otherwise(0)
    n = F.lit(1) if weight is None else F.col(weight)
    rows = (life.select(F.col(group).alias("g"), a.alias("a"), b.alias("b"), (k * n).alias("k"), n.alias("n"))
                .where(F.col("a").isNotNull() & (F.col("a") <= last if last is not None else F.lit(True))
                       & (F.col("b").isNull() | (F.col("b") > F.col("a")))))
    events = F.array(
        F.struct(F.col("a").alias("m"), F.col("n").alias("dn"), F.col("k").alias("dk")),
        F.when(F.col("b") <= last if last is not None else F.col("b").isNotNull(),
               F.struct(F.col("b").alias("m"), (-F.col("n")).alias("dn"), (-F.col("k")).alias("dk"))))
    return (rows.select("g", F.inline(F.filter(events, lambda e: e.isNotNull())))
                  .groupBy("g", "m")
                  .agg(F.sum("dn").alias("dn"), F.sum("dk").alias("dk")))


def headcount_from_deltas(deltas: DataFrame, last: Column, group: str = "location_state", dense: bool = False) -> DataFrame:
    """``(month_start, month_end, <group>, headcount)`` from the deltas of the months up to ``last``."""
    # Running totals over the sparse change months, then each change month
    # spans the months up to the next change (or the spine end). Only
    # groups × months rows exist after the aggregation, so the window's
    # exchange by group moves a small table regardless of input size.
    w = Window.partitionBy("g").orderBy("m")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    sparse = deltas.select(
        "g", "m", F.sum("dn").over(run).alias("n"), F.sum("dk").over(run).alias("hc"),
        F.coalesce(F.add_months(F.lead("m").over(w), -1), last).alias("until"))
    kept = sparse if dense else sparse.where(F.col("n") > 0)
    return (kept.select("g", "hc", F.explode(F.sequence(F.col("m"), F.col("until"), _month()))
                          .alias("m"))
                  .select(F.col("m").alias("month_start"), F.last_day("m").alias("month_end"),
                          F.col("g").alias(group), F.col("hc").alias("headcount")))


def headcount_rows(dim: DataFrame, fct: DataFrame, group: str = "location_state", key: str = "employee_key",
                   start: str = "hire_date", end: str = "termination_date") -> DataFrame:
    """Weighted rows that count like the lifecycle ``dim LEFT JOIN fct``, without joining them again.

    Each dimension row counts once, open-ended.  The fact already carries its
    employee's ``start`` and ``group`` (null where the employee is unknown, and a
    null start never counts): each fact row counts once up to its end, and one row
    per employee with exits takes the open-ended count back.
    """
    cols = [F.col(key), F.col(group), F.col(start)]
    open_end = F.lit(None).cast(fct.schema[end].dataType).alias(end)
    known = fct.where(F.col(start).isNotNull() & F.col(key).isNotNull())
    taken_back = known.select(*cols).dropDuplicates([key])
    return (dim.select(*cols, open_end, F.lit(1).alias("weight"))
            .unionByName(known.select(*cols, F.col(end), F.lit(1).alias("weight")))
            .unionByName(taken_back.select(*cols, open_end, F.lit(-1).alias("weight"))))


def monthly_exits(fct: DataFrame, group: str = "location_state",
                  date_col: str = "termination_date", voluntary: str = "is_voluntary",
                  regrettable: str = "is_regrettable") -> DataFrame:
    """Exits per (month, group): total and voluntary / not voluntary / regrettable."""
    return (fct.where(F.col(date_col).isNotNull())
               .groupBy(month_start(date_col).alias("month_start"), F.col(group))
               .agg(F.count(F.lit(1)).alias("total_terminations"),
                    F.count_if(F.col(voluntary)).alias("voluntary_terminations"),
                    F.count_if(~F.col(voluntary)).alias("involuntary_terminations"),
                    F.count_if(F.col(regrettable)).alias("regrettable_terminations")))


EXIT_COUNTS = ["total_terminations", "voluntary_terminations", "involuntary_terminations",
               "regrettable_terminations"]


def monthly_combined(hc: DataFrame, exits: DataFrame, group: str = "location_state") -> DataFrame:
    """Headcount rows with that month's exits, zero-filled (plain equality: null groups never match).

    Both sides hold at most groups × months rows; AQE picks a broadcast from the
    measured shuffle size when one side is small enough.
    """
    e = exits.select(F.col("month_start").alias("_m"), F.col(group).alias("_g"), *EXIT_COUNTS)
    j = hc.join(e, (hc["month_start"] == e["_m"]) & (hc[group] == e["_g"]), "left")
    return j.select("month_start", "month_end", group,
                    F.col("headcount").alias("eom_headcount"),
                    *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in EXIT_COUNTS])
