"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from attrix.schema import SURROGATE_NULL


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*cols) -> Column:
    """md5 over the parts cast to string, nulls replaced by a marker, joined by '-'.

    Deterministic and engine-independent (Spark's and DuckDB's md5 agree), so a
    key built here joins to a key built anywhere else from the same parts.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts))
