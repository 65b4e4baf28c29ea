"""Trailing-window turnover rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from attrix.functions.dates import as_date, month_start
from attrix.functions.text import flag
from attrix.schema import ROLLING_MONTHS


def _rate(num: str, den: str):
    return F.round(F.col(num) / F.nullif(F.col(den), F.lit(0)) * 100, 2)


def rolling_turnover(monthly: DataFrame, months: int = ROLLING_MONTHS,
                     group: str = "location_state", order: str = "month_start",
                     as_of=None) -> DataFrame:
    """Trailing ``months``-row sums of exits, mean headcount and turnover rates (%).

    The frame counts rows, not calendar months (a month missing from the input
    widens the window). All six aggregates share one window spec, so Spark
    evaluates them in a single Window operator after one exchange by ``group``;
    the input has one row per (group, month), so no partition can grow with
    the number of employees.
    """
    w = Window.partitionBy(group).orderBy(order).rowsBetween(-(months - 1), 0)
    out = monthly.select(
        "month_start", "month_end", group, "eom_headcount",
        F.avg("eom_headcount").over(w).alias("rolling_12m_avg_headcount"),
        "total_terminations", "voluntary_terminations", "involuntary_terminations",
        "regrettable_terminations",
        F.sum("total_terminations").over(w).alias("rolling_12m_terminations"),
        F.sum("voluntary_terminations").over(w).alias("rolling_12m_voluntary"),
        F.sum("involuntary_terminations").over(w).alias("rolling_12m_involuntary"),
        F.sum("regrettable_terminations").over(w).alias("rolling_12m_regrettable"),
        F.count(F.lit(1)).over(w).alias("months_in_window"),
    )
    out = out.select(
        "month_start", "month_end", group, "eom_headcount", "rolling_12m_avg_headcount",
        "total_terminations", "voluntary_terminations", "involuntary_terminations",
        "regrettable_terminations", "rolling_12m_terminations", "rolling_12m_voluntary",
        "rolling_12m_involuntary", "rolling_12m_regrettable",
        _rate("rolling_12m_terminations", "rolling_12m_avg_headcount").alias("rolling_12m_turnover_rate"),
        _rate("rolling_12m_voluntary", "rolling_12m_avg_headcount").alias("rolling_12m_voluntary_rate"),
        _rate("rolling_12m_involuntary", "rolling_12m_avg_headcount").alias("rolling_12m_involuntary_rate"),
        _rate("rolling_12m_regrettable", "rolling_12m_avg_headcount").alias("rolling_12m_regrettable_rate"),
        flag(F.col("months_in_window") < months).alias("is_partial_window"),
        "months_in_window",
    )
    if as_of is not None:
        out = out.where(F.col(order) <= month_start(as_date(as_of)))
    return out
