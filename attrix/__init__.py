"""attrix — workforce turnover analytics as Spark DataFrame operators.

Layers:
  sources/    read/land/stage files (report JSON, Hive-partitioned Parquet)
  streaming/  incremental file ingest with Structured Streaming
  functions/  Column-level helpers (keys, dates, text, buckets)
  operators/  column-parameterised DataFrame operators (dedup, headcount,
              rolling windows, data-quality checks, run log)
  plans/      the composed models (staging, dimension, facts, marts, nightly run)
"""

__version__ = "0.1.0"
