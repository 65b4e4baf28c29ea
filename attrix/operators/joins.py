"""Join operators: reference flags, context enrichment, lifecycle, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_HIT = "__attrix_hit"


def flag_referenced(df: DataFrame, id_col: str, ref: DataFrame, ref_col: str,
                    out: str = "is_manager") -> DataFrame:
    """``out`` = True when ``df.id_col`` appears in ``ref.ref_col`` (nulls ignored).

    The referenced values are de-duplicated first (partial aggregation, so a value
    referenced by a third of all rows is combined map-side), which makes the
    right side unique: the left join never fans out and carries no skewed key.
    """
    refs = (ref.select(F.col(ref_col).alias(_HIT + "_k"))
               .where(F.col(_HIT + "_k").isNotNull())
               .distinct()
               .withColumn(_HIT, F.lit(True)))
    return (df.join(refs, df[id_col] == refs[_HIT + "_k"], "left")
              .withColumn(out, F.coalesce(F.col(_HIT), F.lit(False)))
              .drop(_HIT, _HIT + "_k"))


def lifecycle(dim: DataFrame, fct: DataFrame, key: str = "employee_key",
              carry=("employee_id", "hire_date", "location_state", "location_country",
                     "department"),
              end_col: str = "termination_date") -> DataFrame:
    """dim LEFT JOIN fct on ``key``: one row per (employee, exit), null end if none.

    Written as inner join ∪ anti join: a repeat leaver whose key holds a large
    share of the fact rows sits on the side AQE can split for an inner join,
    while a left outer join cannot split its right side. The anti join reads
    the distinct fact keys only.
    """
    left = dim.select(key, *carry)
    ends = fct.select(key, end_col)
    matched = left.join(ends, key, "inner")
    fkeys = fct.select(key).where(F.col(key).isNotNull()).distinct()
    unmatched = left.join(fkeys, key, "left_anti").withColumn(
        end_col, F.lit(None).cast(fct.schema[end_col].dataType))
    cols = [key, *carry, end_col]
    return matched.select(*cols).unionByName(unmatched.select(*cols))


def relationships(child: DataFrame, child_col: str, parent: DataFrame,
                  parent_col: str) -> DataFrame:
    """Child rows whose non-null key is absent from the parent (referential check).

    Parent keys are de-duplicated first; the anti join can then split a hot
    child key under AQE (left side of a left-anti join is splittable).
    """
    keys = parent.select(F.col(parent_col).alias(_HIT + "_p")).distinct()
    return (child.where(F.col(child_col).isNotNull())
                 .join(keys, F.col(child_col) == F.col(_HIT + "_p"), "left_anti"))
