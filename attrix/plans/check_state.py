"""Data-quality checks whose states add up, so that a night looks at changed buckets only.

Every check of a suite is a table of counts: how many rows are null, how often each failing
value stands, how often each value of a unique column or of a referenced key does.  Counts of
disjoint rows add, and those of a bucket that a night replaced are taken back by counting its
old files.  The states of all checks lie in one table of the store (``attrix.sources.versioned``),
bucketed by (check, value), which makes uniqueness a matter of one bucket; a second table holds
each bucket's failures, so that the result is a sum over a few rows per check.

``update_checks`` commits the states with the version whose rows they describe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from attrix.functions.dates import as_date
from attrix.operators.quality import Check, _grouped
from attrix.sources.versioned import Snapshot, Store, bucket_of

STATES, FAILURES = "check_states", "check_failures"
_KEY = ["i", "v1", "v2"]
_STATE = "i int, v1 string, v2 string, n long, p long"


def _entry(i: int, cond: Column, v1: Column | None = None, v2: Column | None = None, parent: bool = False) -> Column:
    text = lambda v: (F.lit(None) if v is None else v).cast("string")
    return F.when(cond, F.struct(F.lit(i).alias("i"), text(v1).alias("v1"), text(v2).alias("v2"),
                                 F.lit(int(not parent)).cast("long").alias("n"), F.lit(int(parent)).cast("long").alias("p")))


def _entries(model: str, df: DataFrame, checks: Sequence[Check]) -> list[Column]:
    """What a row of ``model`` adds to the states, one column a check that looks at it."""
    out = []
    for i, c in enumerate(checks):
        if c.test == "relationships":
            if c.model == model:
                out.append(_entry(i, F.col(c.column).isNotNull(), F.col(c.column)))
            if c.args["to"] == model:
                key = F.col(c.args["field"])
                out.append(_entry(i, key.isNotNull(), key, parent=True))
        elif c.model == model:
            if c.test == "not_null":
                out.append(_entry(i, F.col(c.column).isNull()))
            elif c.test == "rule":
                out.append(_entry(i, F.expr(c.args["fails"])))
            else:
                value, cond, _ = _grouped(c, df)
                out.append(_entry(i, cond, value["v1"], value["v2"]))
    return out


def check_counts(models: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(i, v1, v2, n, p): per check and value, the counted rows and, for references, the rows of the parent."""
    parts = []
    for model, df in models.items():
        entries = _entries(model, df, checks)
        if entries:
            parts.append(df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _summed(out)


def _summed(states: DataFrame) -> DataFrame:
    return states.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.sum("p").alias("p")).where("n <> 0 or p <> 0")


def _failures(states: DataFrame, checks: Sequence[Check], as_of, *by: str) -> DataFrame:
    """(i, failures) of the given states, also per ``by``."""
    n, p = F.col("n"), F.col("p")
    failing = (F.when(_of(checks, "relationships"), F.when(p == 0, n).otherwise(0))
               .when(_of(checks, "unique"), (n > 1).cast("long"))
               .when(_of(checks, "not_null", "rule"), n)
               # a day that lay in the future when it was counted may have come since
               .when(_of(checks, "not_in_future"), (F.col("v1").try_cast("date") > as_date(as_of)).cast("long"))
               .otherwise((n > 0).cast("long")))
    return states.groupBy("i", *by).agg(F.sum(F.coalesce(failing, F.lit(0).cast("long"))).alias("failures"))


def _of(checks: Sequence[Check], *tests: str) -> Column:
    return F.col("i").isin([i for i, c in enumerate(checks) if c.test in tests])


def _names(checks: Sequence[Check]) -> list[str]:
    return [c.name if c.test == "not_in_future" else f"{c.name}:{sorted(c.args.items())}" for c in checks]


def update_checks(store: Store, checks: Sequence[Check], as_of, buckets: int = 64) -> DataFrame:
    """Bring the stored states up to the store's current tables; returns (test, model, column, severity, failures).

    Read are the buckets that changed since the last call, in their old and their new files
    (``vacuum`` must have left the old ones).  ``rule`` is one more test beside those of the
    suite: its argument ``fails`` is SQL for a row's failing.  The list of checks is fixed by the
    first call; days may only go forward.
    """
    spark, tx = store.spark, store.begin()
    models = sorted({c.model for c in checks} | {c.args["to"] for c in checks if c.test == "relationships"})
    now = {m: tx.base.tables[m]["folders"] for m in models}
    was = {m: {} for m in models}
    if STATES in tx.base:
        settings = tx.base.tables[STATES]["settings"]
        if settings["checks"] != _names(checks):
            raise ValueError("the stored states are those of other checks")
        was = settings["folders"]

    def only(folders: dict) -> dict[str, DataFrame]:
        """The models with the given bucket folders and no others."""
        return {m: Snapshot(spark, store.path, 0, {m: tx.base.tables[m] | {"folders": f}}).read(m) for m, f in folders.items() if f}

    changed = {m: {b for b in {*now[m], *was[m]} if now[m].get(b) != was[m].get(b)} for m in models}
    if not any(changed.values()) and STATES in tx.base:
        return _result(tx.base, checks, as_of)
    new = only({m: {b: now[m][b] for b in changed[m] if b in now[m]} for m in models})
    old = only({m: {b: was[m][b] for b in changed[m] if b in was[m]} for m in models})
    none = spark.createDataFrame([], _STATE)
    delta = _summed((check_counts(new, checks) if new else none).unionByName(
        (check_counts(old, checks) if old else none).select(*_KEY, (-F.col("n")).alias("n"), (-F.col("p")).alias("p"))))
    if STATES in tx.base:
        # the difference is asked for twice: its buckets, then its rows
        delta = tx.keep(delta, "check-delta")
        touched = tx.base.touched(STATES, delta.select(*_KEY))
        tx.replace(STATES, _summed(tx.base.read(STATES, touched).unionByName(delta)), _KEY, touched)
    else:
        touched = None
        tx.replace(STATES, delta, _KEY, buckets=buckets)
    t = tx.now.tables[STATES]
    t["settings"] = {"checks": _names(checks), "folders": now}
    fresh = tx.now.read(STATES, touched).where(~_of(checks, "not_in_future"))
    fresh = _failures(fresh.withColumn("b", bucket_of(_KEY, t["buckets"])), checks, as_of, "b")
    if touched is not None:
        fresh = tx.base.read(FAILURES).where(~F.col("b").isin(touched)).unionByName(fresh)
    tx.replace(FAILURES, fresh, ["i"], buckets=1)
    tx.commit()
    tx.done()
    return _result(tx.now, checks, as_of)


def _result(snapshot: Snapshot, checks: Sequence[Check], as_of) -> DataFrame:
    """(test, model, column, severity, failures): a row for every check, zero where nothing fails."""
    spark = snapshot.spark
    found = snapshot.read(FAILURES).select("i", "failures").unionByName(
        _failures(snapshot.read(STATES).where(_of(checks, "not_in_future")), checks, as_of))
    found = found.groupBy("i").agg(F.sum("failures").alias("failures"))
    names = spark.createDataFrame([(i, c.name, c.model, c.column, c.severity) for i, c in enumerate(checks)],
                                  "i int, test string, model string, column string, severity string")
    return names.join(found, "i", "left").select("test", "model", "column", "severity",
                                                 F.coalesce("failures", F.lit(0).cast("long")).alias("failures"))
