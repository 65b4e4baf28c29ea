"""Data-quality checks. Each returns the FAILING rows; an empty result passes.

Generic column checks (unique, not_null, accepted_values, relationships,
not_in_future, not_before_column, is_between), business-rule checks on the
models, freshness, and a suite runner that evaluates a declarative list of
checks into one ``(test, model, column, severity, failures)`` table with a
single job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from attrix.functions.dates import as_date, as_timestamp
from attrix.operators import joins


def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null values that occur more than once (partial aggregation; skew-safe)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values outside the list, with counts; null is not a failure."""
    return (df.groupBy(F.col(col).alias("value_field"))
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(~F.col("value_field").isin(list(values))))


def relationships(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child keys (non-null) with no parent row."""
    return joins.relationships(child, child_col, parent, parent_col).select(
        F.col(child_col).alias("from_field"))


def not_in_future(df: DataFrame, col: str, as_of) -> DataFrame:
    return (df.where(F.col(col) > as_date(as_of))
              .groupBy(F.col(col).alias("failing_value"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def not_before_column(df: DataFrame, col: str, ref: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull() & F.col(ref).isNotNull() & (F.col(col) < F.col(ref)))
              .groupBy(F.col(col).alias("failing_value"), F.col(ref).alias("reference_value"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def is_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return (df.where(F.col(col).isNotNull() & ((F.col(col) < lo) | (F.col(col) > hi)))
              .groupBy(F.col(col).alias("failing_value"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def freshness(df: DataFrame, col: str, as_of, warn_hours: int = 25,
              error_hours: int = 48) -> DataFrame:
    """One row: newest ``col``, its age in whole hours at ``as_of`` and pass / warn / error by elapsed time."""
    now = as_timestamp(as_of)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)   # elapsed time, not hour marks crossed
    return (df.agg(F.max(col).alias("max_loaded_at"))
              .select("max_loaded_at", now.alias("snapshotted_at"), F.floor(age / 3600).cast("bigint").alias("age_hours"),
                      F.when(F.col("max_loaded_at").isNull() | (age > error_hours * 3600), F.lit("error"))
                       .when(age > warn_hours * 3600, F.lit("warn")).otherwise(F.lit("pass"))
                       .alias("status")))


# --- business rules on the models -------------------------------------------------

def termination_after_hire(fct: DataFrame) -> DataFrame:
    """Exits dated before the hire date."""
    return not_before_column(fct, "termination_date", "hire_date")


def last_day_lte_termination(stg_t: DataFrame) -> DataFrame:
    return stg_t.where(ROW_RULES["last_day_lte_termination"]())


def active_with_termination(stg_e: DataFrame, stg_t: DataFrame) -> DataFrame:
    """Active employees that have a termination record (semi join on the employee key)."""
    keys = stg_t.select("employee_key").distinct()
    return stg_e.where(F.col("is_active")).join(keys, "employee_key", "left_semi")


def terminated_without_exit(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """TERMINATED employees with no termination record (they count as active for ever)."""
    keys = fct.select("employee_key").distinct()
    return (dim.where(F.col("employment_status") == "TERMINATED")
               .join(keys, "employee_key", "left_anti"))


#: Rules on single rows, as conditions: the suite counts them in the model's one aggregate pass.
ROW_RULES = {
    "last_day_lte_termination": lambda: F.col("last_day_of_work") > F.col("termination_date"),
    "headcount_non_negative": lambda: F.col("eom_headcount") < 0,
    "regrettable_subset": lambda: (F.col("regrettable_terminations") > F.col("voluntary_terminations"))
    | (F.col("rolling_12m_regrettable") > F.col("rolling_12m_voluntary")),
    "types_sum_to_total": lambda: (F.col("voluntary_terminations") + F.col("involuntary_terminations")
                                   != F.col("total_terminations"))
    | (F.col("rolling_12m_voluntary") + F.col("rolling_12m_involuntary") != F.col("rolling_12m_terminations")),
}


def headcount_non_negative(mart: DataFrame) -> DataFrame:
    return mart.where(ROW_RULES["headcount_non_negative"]())


def regrettable_subset(mart: DataFrame) -> DataFrame:
    return mart.where(ROW_RULES["regrettable_subset"]())


def types_sum_to_total(mart: DataFrame) -> DataFrame:
    return mart.where(ROW_RULES["types_sum_to_total"]())


def spine_contiguous(mart: DataFrame, group: str = "location_state",
                     order: str = "month_start") -> DataFrame:
    """Rows whose previous month in the same group is not exactly one month earlier."""
    w = Window.partitionBy(group).orderBy(order)
    prev = F.lag(order).over(w)
    return (mart.select(group, order, prev.alias("previous_month"))
                .where(F.col("previous_month").isNotNull()
                       & (F.add_months(F.col("previous_month"), 1) != F.col(order))))


# --- suite ------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    model: str
    column: str | None
    test: str
    args: dict = field(default_factory=dict)
    severity: str = "error"

    @property
    def name(self) -> str:
        shown = ("reference_column", "min_value", "max_value")
        suffix = "".join(f"_{self.args[k]}" for k in shown if k in self.args)
        return f"{self.test}_{self.model}_{self.column or ''}{suffix}".rstrip("_")


GENERIC: dict[str, Callable] = {
    "unique": lambda df, c, a, m: unique(df, c),
    "not_null": lambda df, c, a, m: not_null(df, c),
    "accepted_values": lambda df, c, a, m: accepted_values(df, c, a["values"]),
    "relationships": lambda df, c, a, m: relationships(df, c, m[a["to"]], a["field"]),
    "not_in_future": lambda df, c, a, m: not_in_future(df, c, a["as_of"]),
    "not_before_column": lambda df, c, a, m: not_before_column(df, c, a["reference_column"]),
    "is_between": lambda df, c, a, m: is_between(df, c, a["min_value"], a["max_value"]),
}


def failing_rows(check: Check, models: dict[str, DataFrame]) -> DataFrame:
    return GENERIC[check.test](models[check.model], check.column, check.args, models)


def _row(name, model, column, severity, failures) -> "F.Column":
    return F.struct(F.lit(name).alias("test"), F.lit(model).alias("model"),
                    F.lit(column).cast("string").alias("column"),
                    F.lit(severity).alias("severity"), failures.cast("bigint").alias("failures"))


# Checks whose failures are counted as distinct failing values: (check → value column,
# failing-row condition, extra condition on the group count)
def _grouped(c: Check, df: DataFrame):
    col = F.col(c.column)
    a = c.args
    none = F.lit(None).cast("string")
    one = F.struct(col.cast("string").alias("v1"), none.alias("v2"))
    if c.test == "unique":
        return one, col.isNotNull(), "n > 1"
    if c.test == "accepted_values":
        return one, col.isNotNull() & ~col.isin(list(a["values"])), None
    if c.test == "not_in_future":
        return one, col > as_date(a["as_of"]), None
    if c.test == "is_between":
        return one, col.isNotNull() & ((col < a["min_value"]) | (col > a["max_value"])), None
    if c.test == "not_before_column":
        ref = F.col(a["reference_column"])
        return (F.struct(col.cast("string").alias("v1"), ref.cast("string").alias("v2")),
                col.isNotNull() & ref.isNotNull() & (col < ref), None)
    return None


def _grouped_counts(df: DataFrame, cks: list[Check]) -> DataFrame:
    """Failure counts of several grouped checks on one model with one shuffle.

    Each row emits one (check index, value) pair per check it fails (for
    ``unique``: per non-null value); a partially aggregated count per pair and a
    count of qualifying pairs per check give every check's failures. The
    exchange carries at most rows × checks pairs, the same volume as one
    shuffle per check, in one stage.
    """
    pairs, having = [], {}
    for i, c in enumerate(cks):
        value, cond, hv = _grouped(c, df)
        pairs.append(F.when(cond, F.struct(F.lit(i).alias("i"), value.alias("v"))))
        if hv:
            having[i] = hv
    exploded = df.select(F.explode(F.filter(F.array(*pairs), lambda x: x.isNotNull())).alias("p"))
    grouped = (exploded.groupBy(F.col("p.i").alias("i"), F.col("p.v").alias("v"))
                       .agg(F.count(F.lit(1)).alias("n")))
    keep = F.lit(True)
    for i, hv in having.items():
        keep = F.when(F.col("i") == i, F.expr(hv)).otherwise(keep)
    counts = grouped.where(keep).groupBy("i").agg(F.count(F.lit(1)).alias("failures"))
    # every check gets a row, zero when nothing failed
    spark = df.sparkSession
    meta = spark.createDataFrame([(i, c.name, c.model, c.column, c.severity) for i, c in enumerate(cks)],
                                 "i int, test string, model string, column string, severity string")
    return (meta.join(F.broadcast(counts), "i", "left")
                .select("test", "model", "column", "severity",
                        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures")))


def run_suite(checks: Sequence[Check], models: dict[str, DataFrame],
              extra: dict[str, tuple[str, str, DataFrame | Column]] | None = None) -> DataFrame:
    """All checks as one lazy table ``(test, model, column, severity, failures)``.

    Per model: all ``not_null`` checks and row rules share one aggregate pass
    (``count_if`` each) and all value-grouped checks share one shuffle
    (``_grouped_counts``); ``relationships`` checks are anti joins.
    ``extra`` maps test name → (model, severity, failing-rows DataFrame, or the
    condition of failing rows).
    Pass materialised models: each pass re-reads its model.
    """
    parts = []
    by_model: dict[str, dict[str, list[Check]]] = {}
    for c in checks:
        kind = "nn" if c.test == "not_null" else ("rel" if c.test == "relationships" else "grp")
        by_model.setdefault(c.model, {}).setdefault(kind, []).append(c)
    rules: dict[str, list] = {}
    for name, (model, severity, rule) in (extra or {}).items():
        if isinstance(rule, Column):
            rules.setdefault(model, []).append((name, None, severity, rule))
            by_model.setdefault(model, {})
    for model, kinds in by_model.items():
        df = models[model]
        rows = [(c.name, c.column, c.severity, F.col(c.column).isNull()) for c in kinds.get("nn", [])] + rules.get(model, [])
        if rows:
            agg = df.agg(*[F.count_if(cond).alias(f"n{i}") for i, (_, _, _, cond) in enumerate(rows)])
            parts.append(agg.select(F.inline(F.array(*[
                _row(name, model, column, severity, F.col(f"n{i}"))
                for i, (name, column, severity, _) in enumerate(rows)]))))
        if kinds.get("grp"):
            parts.append(_grouped_counts(df, kinds["grp"]))
        for c in kinds.get("rel", []):
            cnt = failing_rows(c, models).agg(F.count(F.lit(1)).alias("n"))
            parts.append(cnt.select(F.inline(F.array(_row(c.name, c.model, c.column, c.severity,
                                                          F.col("n"))))))
    for name, (model, severity, df) in (extra or {}).items():
        if isinstance(df, Column):
            continue
        cnt = df.agg(F.count(F.lit(1)).alias("n"))
        parts.append(cnt.select(F.inline(F.array(_row(name, model, None, severity, F.col("n"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_on_error(result: DataFrame) -> list:
    """Collect the (small: one row per check) suite result; raise if an error check failed."""
    rows = result.collect()
    bad = [r for r in rows if r["severity"] == "error" and r["failures"] > 0]
    if bad:
        raise AssertionError("data-quality errors: " + ", ".join(
            f"{r['test']}={r['failures']}" for r in bad))
    return rows
