"""Order-preserving numbers for any sortable column, and the quantile bounds of a table.

Both serve to deal rows out by range without sorting them: where equal numbers fall does not
matter to a caller that counts or sorts what it has dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_PREFIX = 6    # bytes of a text that its number holds; 48 bits are exact in a double


def sortable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.StringType))


def order_code(df: DataFrame, name: str) -> Column:
    """A double that never decreases as the column increases; null for null."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, _PREFIX)), 2 * _PREFIX, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def quantile_bounds(df: DataFrame, names: list[str], pieces: int) -> tuple[int, dict[str, list[float]]]:
    """Rows of ``df``, and per column at most ``pieces - 1`` increasing values that cut it into about equal shares.

    One aggregation with mergeable sketches; what reaches the driver is its one row.
    """
    grid = [i / pieces for i in range(1, pieces)]
    row = df.agg(F.count(F.lit(1)), *[F.percentile_approx(order_code(df, n), grid, 20 * pieces) for n in names]).first()
    return row[0], {n: sorted(set(q or [])) for n, q in zip(names, row[1:])}


def piece_of(code: Column, bounds: list[float]) -> Column:
    """How many bounds lie below: 0 to len(bounds); a null comes after all, as len(bounds) + 1."""
    below = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b < code)) if bounds else F.lit(0)
    return F.when(code.isNull(), F.lit(len(bounds) + 1)).otherwise(below)
