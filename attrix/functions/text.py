"""Text standardisation (blank-trimming; tabs are kept, as the warehouse does)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(c) -> Column:
    return F.trim(_c(c))


def clean_upper(c) -> Column:
    return F.upper(F.trim(_c(c)))


def clean_lower(c) -> Column:
    return F.lower(F.trim(_c(c)))


def flag(cond: Column) -> Column:
    """Searched CASE → boolean that is never null (null condition → false)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
