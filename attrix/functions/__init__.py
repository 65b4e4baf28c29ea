"""Column-level helpers built only from pyspark.sql.functions (JVM-side)."""

from attrix.functions.keys import surrogate_key
from attrix.functions.dates import (as_date, month_start, days_between, hours_between,
                                    seconds_between, active_on)
from attrix.functions.text import clean, clean_upper, clean_lower, flag
from attrix.functions.buckets import tenure_bucket

__all__ = ["surrogate_key", "as_date", "month_start", "days_between", "hours_between",
           "seconds_between", "active_on", "clean", "clean_upper", "clean_lower", "flag",
           "tenure_bucket"]
