"""Date and time helpers.

Argument order follows "from, to" (like the warehouse ``datediff(part, a, b)``),
which is the reverse of Spark's ``datediff(end, start)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x)
    return F.col(x)


def as_date(d) -> Column:
    """A date literal from 'yyyy-MM-dd' / date / Column."""
    if isinstance(d, str):
        return F.lit(_dt.date.fromisoformat(d))
    return _c(d)


def as_timestamp(t) -> Column:
    """A timestamp (no time zone) literal from an ISO string / datetime / Column."""
    if isinstance(t, _dt.datetime):
        t = t.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(t, str):
        return F.lit(t).cast("timestamp_ntz")
    return _c(t)


def month_start(c) -> Column:
    """First day of the month as DATE (``trunc``, not ``date_trunc`` which is a timestamp)."""
    return F.trunc(_c(c), "MM")


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (positive when end is later)."""
    return F.datediff(_c(end), _c(start))


def hours_between(start, end) -> Column:
    """Hour boundaries crossed from ``start`` to ``end`` (warehouse semantics).

    Truncating both sides to the hour first makes 10:59 → 11:01 count as 1, as a
    boundary-counting ``datediff('hour', ...)`` does.
    """
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", _c(start)),
                            F.date_trunc("HOUR", _c(end)))


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", F.date_trunc("SECOND", _c(start)),
                            F.date_trunc("SECOND", _c(end)))


def active_on(day, start_col="hire_date", end_col="termination_date") -> Column:
    """Started on or before ``day`` and not ended on or before it."""
    d = _c(day)
    return (_c(start_col) <= d) & (_c(end_col).isNull() | (_c(end_col) > d))
