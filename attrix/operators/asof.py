"""As-of counts at any dates: how many rows of each group are active on each date of a spine.

Rows are active on ``[start, end)``.  Each gives +1 at its start and -1 at its end; events of
one group and day are summed first (a hot group is combined before the shuffle).  The spine's
dates join the events of every group as rows without weight, and the count at a date is the
running sum up to it.  The merged rows are dealt out by range of (group, day), so a group of
any size lies across tasks; each range sums for itself, and what the ranges before it hold of
its first group is added from a table of one row per range and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from attrix.session import scratch_path

_SPREAD = 64


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def change_events(life: DataFrame, group: str, key: str, start: str, end: str) -> DataFrame:
    """(g, day, dn, dk): change of the active rows, and of those with a key, per group and day."""
    rows = life.select(F.col(group).alias("g"), F.col(start).alias("a"), F.col(end).alias("b"),
                       F.when(F.col(key).isNotNull(), 1).otherwise(0).alias("k"))
    rows = rows.where(F.col("a").isNotNull() & (F.col("b").isNull() | (F.col("b") > F.col("a"))))
    events = F.array(F.struct(F.col("a").alias("day"), F.lit(1).alias("dn"), F.col("k").alias("dk")),
                     F.when(F.col("b").isNotNull(), F.struct(F.col("b").alias("day"), F.lit(-1).alias("dn"), (-F.col("k")).alias("dk"))))
    return (rows.select("g", F.inline(F.filter(events, lambda e: e.isNotNull())))
            .groupBy("g", "day").agg(F.sum("dn").alias("dn"), F.sum("dk").alias("dk")))


def running_totals(rows: DataFrame, group: str, order: list[str], sums: list[str]) -> DataFrame:
    """``rows`` with each of ``sums`` replaced by its running total within ``group`` along ``order``.

    No task holds a group: rows are ranged by (group, order), totals are local to a range, and the
    part of a group in earlier ranges comes from one row per (range, group).  ``order`` must be unique in a group.
    """
    ranged = rows.repartitionByRange(group, *order).withColumn("_p", F.spark_partition_id())
    ranged = _stored(ranged, "ranged")       # which row is in which range must not change once it is used
    local = Window.partitionBy("_p", group).orderBy(*order)
    within = ranged.select(*[c for c in ranged.columns if c not in sums], *[F.sum(c).over(local).alias(c) for c in sums])
    ahead = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy("_p", group).agg(*[F.sum(c).alias(c) for c in sums])
              .select(F.col("_p").alias("_q"), F.col(group).alias("_g"), *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_b_{c}") for c in sums]))
    joined = within.join(before, (F.col("_p") == F.col("_q")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*[(F.col(c) + F.col(f"_b_{c}")).alias(c) if c in sums else F.col(c) for c in rows.columns])


def asof_headcount(life: DataFrame, spine: DataFrame, date: str = "as_of_date", group: str = "location_state",
                   key: str = "employee_key", start: str = "hire_date", end: str = "termination_date",
                   dense: bool = False) -> DataFrame:
    """``(as_of_date, <group>, headcount)`` for every distinct date of ``spine[date]``.

    A row counts on a day from ``start`` on and before ``end`` (see ``active_on``).  As with the
    grouped count it reproduces, a (date, group) row is there only if a row is active, unless
    ``dense`` asks for zeros between a group's first day and its last; ``headcount`` counts non-null
    keys.  A null group is a group, a null start never counts, and null dates are left out.
    """
    changes = _stored(change_events(life, group, key, start, end), "changes")
    # a group is asked for dates from its first event on, and to its last one if nothing is left then
    spans = changes.groupBy("g").agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.sum("dn").alias("left"))
    dates = spine.select(F.col(date).cast("date").alias("day")).where("day is not null").distinct()
    # every group meets every date: an equi-join on a spread of the dates, so no task pairs all with all
    dates = dates.withColumn("s", F.pmod(F.xxhash64("day"), F.lit(_SPREAD)))
    spans = spans.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SPREAD - 1).cast("long"))))
    asked = (spans.join(dates, "s").where((F.col("day") >= F.col("lo")) & ((F.col("left") != 0) | (F.col("day") < F.col("hi"))))
             .select("g", "day", F.lit(1).alias("asked"), F.lit(0).cast("long").alias("dn"), F.lit(0).cast("long").alias("dk")))
    merged = changes.select("g", "day", F.lit(0).alias("asked"), "dn", "dk").unionByName(asked)
    # changes of a day come before the question: a start counts on its day, an end does not
    counted = running_totals(merged, "g", ["day", "asked"], ["dn", "dk"]).where("asked = 1")
    if not dense:
        counted = counted.where("dn > 0")
    return counted.select(F.col("day").alias("as_of_date"), F.col("g").alias(group), F.col("dk").alias("headcount"))
