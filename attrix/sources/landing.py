"""Landing zone: report JSON in, typed date-partitioned Parquet out, typed raw rows.

* ``read_report_json`` — unnest the ``data`` array of report envelopes.
* ``stage`` — coerce dates, add lineage columns and page numbers, and append
  snappy Parquet under ``<base>/<entity>/year=/month=/day=``.
* ``read_landing`` / ``to_raw`` — scan one entity's landing files and cast to
  the declared raw types (bad values become null, never fail the load).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from attrix.functions.dates import as_date, as_timestamp
from attrix.schema import (API, DATE_COLUMNS, LANDING, NATURAL_KEY, PAGE_SIZE, RAW,
                           envelope)
from attrix.functions.order import order_code, piece_of, quantile_bounds
from attrix.session import list_files, remove_path, scratch_path

_PID, _MID = "__attrix_pid", "__attrix_mid"


def read_report_json(spark: SparkSession, path: str, record_schema,
                     multiline: bool = True) -> DataFrame:
    """Records from report-envelope JSON: one envelope per file (``multiline``) or per line.

    ``total_records`` is ignored: rows are counted, not trusted from the header.
    An envelope holds one bounded page, so no task sees more than a page at once.
    An envelope that does not parse, or has no ``data`` list, fails the read: its
    records must not get lost silently.
    """
    bad = "_attrix_bad"
    schema = T.StructType([*envelope(record_schema).fields, T.StructField(bad, T.StringType())])
    env = (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", bad).json(path))
    broken = F.raise_error(F.concat(F.lit("unreadable report envelope in "), F.col("_metadata.file_path")))
    data = F.when(F.col(bad).isNotNull() | F.col("data").isNull(), broken.cast(T.ArrayType(record_schema))).otherwise(F.col("data"))
    return env.select(F.explode(data).alias("d")).select("d.*")


def coerce_dates(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """ISO dates and date-times → DATE; an unparseable value becomes null (never an error).

    A date-time gives the date it is written with, whatever its offset.
    ``lost_dates`` counts the values that become null.
    """
    return df.withColumns({c: _date_of(c) for c in _date_strings(df, cols)})


def _date_strings(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = dict(df.dtypes)
    return [c for c in cols if types.get(c) == "string"]


def _date_of(c: str):
    v = F.trim(F.col(c))
    stamped = F.when(F.length(v) > 10, v.try_cast("timestamp"))
    return F.coalesce(F.try_to_date(v, "yyyy-MM-dd"),
                      F.when(stamped.isNotNull(), F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd")))


def lost_dates(df: DataFrame, cols: Sequence[str] = DATE_COLUMNS) -> Column:
    """Number of a row's non-null date strings that ``coerce_dates`` turns into null."""
    return sum((F.when(F.col(c).isNotNull() & _date_of(c).isNull(), 1).otherwise(0)
                for c in _date_strings(df, cols)), F.lit(0))


def with_page_numbers(df: DataFrame, order: Sequence[str], page_size: int = PAGE_SIZE,
                      out: str = "_pipeline_page_num", partitions: int | None = None) -> DataFrame:
    """Zero-based page number = floor(rank / page_size) under ``order`` (made total)."""
    idx = "__attrix_idx"
    return (with_row_index(df, order, idx, partitions)
            .withColumn(out, F.floor(F.col(idx) / page_size).cast("bigint")).drop(idx))


def with_row_index(df: DataFrame, order: Sequence[str], out: str = "row_index",
                   partitions: int | None = None, nulls_last: bool = False) -> DataFrame:
    """Zero-based contiguous rank under ``order`` (made total by the remaining columns).

    Distributed, without a single-partition window: range-partition on the
    order columns and sort by the total order, count rows per partition (one
    row per partition), turn the counts into offsets, and add each row's
    position inside its partition. The offset table is bounded by the
    partition count, so it is broadcast safely.
    """
    keys = [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc()
            for c in [*order, *[c for c in df.columns if c not in order]]]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range bounds on the full total order: a natural key held by a third of the rows
    # is still split across partitions by the remaining columns
    ranged = df.repartitionByRange(n, *keys)
    # The count branch and the index branch must see the same partitions: Spark
    # runs the shared range exchange once (exchange reuse). With reuse switched
    # off each branch would sample its own range bounds, so pin the partitions
    # with a persisted copy (recomputed from the same shuffle after a loss).
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true").lower() == "false":
        ranged = ranged.persist()
    counts = ranged.withColumn(_PID, F.spark_partition_id()).groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    # only the index branch needs its rows sorted
    ranged = (ranged.sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id())
                    .withColumn(_MID, F.monotonically_increasing_id()))
    offsets = counts.select(
        _PID, (F.sum("_n").over(_whole_ordered(_PID)) - F.col("_n")).alias("_off"))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    return (ranged.join(F.broadcast(offsets), _PID)
                  .withColumn(out, (F.col("_off") + local).cast("bigint"))
                  .drop(_PID, _MID, "_off"))


def _whole_ordered(col: str):
    from pyspark.sql import Window
    return Window.orderBy(col).rowsBetween(Window.unboundedPreceding, 0)


def with_lineage(df: DataFrame, entity: str, run_date, written_at=None,
                 page_size: int = PAGE_SIZE) -> DataFrame:
    """Add ``_pipeline_entity/_run_date/_page_num/_written_at``."""
    w = as_timestamp(written_at) if written_at is not None else F.localtimestamp()
    paged = with_page_numbers(df, [NATURAL_KEY.get(entity, df.columns[0])], page_size)
    return (paged.withColumn("_pipeline_entity", F.lit(entity))
                 .withColumn("_pipeline_run_date", as_date(str(run_date)))
                 .withColumn("_pipeline_written_at", w))


def stage(df: DataFrame, entity: str, run_date, base_path: str, written_at=None,
          page_size: int = PAGE_SIZE, records_per_file: int | None = None) -> dict:
    """Append API records of one run as landing Parquet; returns the run summary.

    Files go to ``<base>/<entity>/year=YYYY/month=MM/day=DD/``. Every record
    carries its page number (pages of ``page_size`` in natural-key order), and
    pages are contiguous inside files. File size is a separate knob: by default
    one file per write task, because files of a few hundred records — a memory
    bound for a single-process extractor — would mean millions of tiny files at
    scale; ``records_per_file`` caps rows per file when a consumer needs it.
    The coerced records are written once to the shared folder before they are
    ranked (ranging samples its input), so the input is scanned once; row, page
    and lost-date totals come from an ``Observation`` on the writes themselves.
    An empty input writes no data files.  ``files`` in the summary lists what
    this run wrote.
    """
    run_date = run_date if isinstance(run_date, _dt.date) else _dt.date.fromisoformat(str(run_date))
    schema, spark = LANDING[entity], df.sparkSession
    seen, scratch = Observation(f"records_{entity}"), scratch_path(spark, "records")
    # each date is parsed once: a value is lost where the parsed one is null and the given one is not
    dates = _date_strings(df, DATE_COLUMNS)
    parsed = df.withColumns({f"_date_{c}": _date_of(c) for c in dates})
    lost = sum((F.when(F.col(c).isNotNull() & F.col(f"_date_{c}").isNull(), 1).otherwise(0) for c in dates), F.lit(0))
    counted = parsed.withColumn("_lost", lost).observe(seen, F.sum("_lost").alias("lost"))
    counted.select(*[F.col(f"_date_{c}").alias(c) if c in dates else F.col(c) for c in df.columns]).write.parquet(scratch)
    typed = spark.read.parquet(scratch)
    staged = with_lineage(typed, entity, run_date, written_at, page_size)
    staged = staged.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    obs = Observation(f"stage_{entity}")
    staged = staged.observe(obs, F.count(F.lit(1)).alias("rows"),
                            F.max("_pipeline_page_num").alias("max_page"))
    part = (staged.withColumn("year", F.lit(run_date.year))
                  .withColumn("month", F.lit(f"{run_date.month:02d}"))
                  .withColumn("day", F.lit(f"{run_date.day:02d}"))
                  .sortWithinPartitions("year", "month", "day", "_pipeline_page_num"))   # the write sorts by the first three anyway
    root = f"{base_path.rstrip('/')}/{entity}"
    w = part.write.mode("append").option("compression", "snappy")
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    day_dir = f"{root}/year={run_date.year}/month={run_date.month:02d}/day={run_date.day:02d}"
    before = set(list_files(spark, day_dir))
    w.partitionBy("year", "month", "day").parquet(root)
    remove_path(spark, scratch)
    m = obs.get
    rows = int(m.get("rows") or 0)
    pages = 0 if rows == 0 else int(m["max_page"]) + 1
    return {"entity": entity, "run_date": str(run_date), "records": rows, "pages": pages,
            "dates_lost": int(seen.get.get("lost") or 0), "path": day_dir if rows else None,
            "files": sorted(set(list_files(spark, day_dir)) - before)}


def read_landing(spark: SparkSession, base_path: str, entity: str, start=None,
                 end=None) -> DataFrame:
    """All landing rows of one entity; ``start/end`` prune date partitions by run date."""
    df = (spark.read.schema(LANDING[entity]).option("pathGlobFilter", "*.parquet")
               .option("basePath", f"{base_path.rstrip('/')}/{entity}")
               .parquet(f"{base_path.rstrip('/')}/{entity}"))
    # the directory date (year=/month=/day=) prunes partitions before any file is opened
    part_day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    if start is not None:
        df = df.where((part_day >= as_date(start)) & (F.col("_pipeline_run_date") >= as_date(start)))
    if end is not None:
        df = df.where((part_day <= as_date(end)) & (F.col("_pipeline_run_date") <= as_date(end)))
    return df.select(*[f.name for f in LANDING[entity].fields])


def to_raw(df: DataFrame, entity: str, loaded_at=None) -> DataFrame:
    """Cast landing/API columns to the raw types (try-casts) and stamp ``_loaded_at``."""
    out, types = [], dict(df.dtypes)
    for f in RAW[entity].fields:
        if f.name == "_loaded_at":
            out.append((as_timestamp(loaded_at) if loaded_at is not None
                        else F.localtimestamp()).alias("_loaded_at"))
        elif f.name not in types:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.dataType.typeName() == "timestamp_ntz" and types[f.name] == "string":
            # ISO strings with an offset ('...Z') parse as instants, kept as UTC wall clock
            out.append(F.col(f.name).try_cast("timestamp").cast("timestamp_ntz").alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*out)


ZORDER_BITS = 6


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """The quantile ranks of ``cols`` with their bits interleaved, the first column's first.

    Ranks, not values, so skewed columns use all of the key; equal values have equal ranks.  The
    ranks of a column of few values are spread over the same range as those of the others.
    """
    _, bounds = quantile_bounds(df, list(cols), 1 << bits)
    ranks = [F.floor(piece_of(order_code(df, c), bounds[c]) * (1 << bits) / (len(bounds[c]) + 1)).cast("long") for c in cols]
    key, wide = F.lit(0).cast("long"), bits + 1                     # a null's rank may take one bit more
    for bit in range(wide):
        for i, r in enumerate(ranks):
            place = (wide - 1 - bit) * len(cols) + (len(cols) - 1 - i)
            key = key + F.shiftleft(F.shiftright(r, wide - 1 - bit).bitwiseAND(F.lit(1).cast("long")), place)
    return key


def cluster_for_write(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on the Z-order of the common filter columns before a write.

    Row groups then hold narrow min/max ranges on each of ``cols``, so a filter on any one of
    them skips row groups (the Parquet analogue of table clustering).  The range bounds continue
    over a hash of the row: a nightly snapshot shares one run date, and bounds on the key alone
    could send it all to one task.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    z, row = "__attrix_z", "__attrix_row"
    keyed = df.withColumn(z, zorder_key(df, cols)).withColumn(row, F.xxhash64(*df.columns))
    return keyed.repartitionByRange(n, z, row).sortWithinPartitions(z, *cols, row).drop(z, row)


def api_records(df: DataFrame, entity: str) -> DataFrame:
    """Project a typed frame to the API record shape (dates/timestamps as ISO strings)."""
    cols, types = [], dict(df.dtypes)
    for f in API[entity].fields:
        c = F.col(f.name)
        t = types.get(f.name)
        if t == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif t and t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
