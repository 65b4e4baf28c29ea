"""Dashboard reads: the turnover mart and the exits behind one of its cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from attrix.functions.dates import as_date, month_start


def turnover(spark: SparkSession, mart_path: str, state: str | None = None) -> DataFrame:
    """The rolling mart table, optionally one state (filter pushed to the scan)."""
    df = spark.read.parquet(mart_path)
    return df if state is None else df.where(F.col("location_state") == F.lit(state))


def exits(fct: DataFrame, state: str, month) -> DataFrame:
    """Drill-through: the terminations counted in one (state, month) cell of the mart."""
    first = month_start(as_date(month))   # a plain range on the column reaches the scan
    return fct.where((F.col("location_state") == F.lit(state)) & (F.col("termination_date") >= first)
                     & (F.col("termination_date") < F.add_months(first, 1)))
