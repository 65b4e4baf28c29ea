"""Tenure bucketing from the fixed bounds in ``schema.TENURE_BUCKETS``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from attrix.schema import TENURE_BUCKETS, UNKNOWN_BUCKET


def tenure_bucket(days: Column, unknown_when: Column | None = None) -> Column:
    """Label for a day count; a null count falls through to the last label.

    ``unknown_when``: optional condition that yields ``Unknown`` first (used for
    tenure at exit when the hire date is missing).
    """
    expr = None
    if unknown_when is not None:
        expr = F.when(unknown_when, F.lit(UNKNOWN_BUCKET))
    for bound, label in TENURE_BUCKETS:
        if bound is None:
            return expr.otherwise(F.lit(label))
        cond = days < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
