"""Incremental ingest of landing files into the raw tables (Structured Streaming).

The stream tracks landing *files*: a ``binaryFile`` source over
``<landing>/<entity>/`` (suffix filter ``*.parquet``, content never read) hands
each micro-batch the paths and sizes of newly arrived files. ``write_batch``
reads them with the declared schema, casts to the raw types, stamps
``_loaded_at`` and writes the rows plus one load-history row per file.

* Exactly once per file: the stream's checkpointed file log.
* Exactly once per row: each micro-batch writes its own partition (stream id,
  batch id) in overwrite mode, so a batch that is replayed before it was
  finished replaces its output, a finished one is left alone, and a stream with a
  new checkpoint adds to the table.
* Rows and history together: a batch shows in neither table before its manifest
  (``<raw>/_batches/<stream id>.<batch id>``) appears, which is written last.
  ``read_raw`` and ``read_history`` read the batches that have one.
* One scan: the rows carry their file and the columns that lost a value in the
  cast, and the history is summed from these two columns of what was written.
* Foreign files: if the batch cannot be read with the declared schema (a page
  whose all-null column was written with another physical type), files are
  checked one by one: compatible footers are read with the declared schema,
  others with their own schema and cast column by column; a file that cannot
  be read at all is recorded as ``LOAD_FAILED`` with its error, and the rest of
  the batch still loads. Rows are never dropped silently.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from attrix.functions.dates import as_timestamp
from attrix.schema import LANDING, LOAD_HISTORY, RAW, RAW_CLUSTER
from attrix.session import bare_path, create_text, list_files, path_exists, read_text

BATCH_COL, STREAM_COL = "_batch_id", "_stream_id"
FILE_COL, LOST_COL = "_file", "_lost"
_MANIFESTS, _RAW_OF = "_batches", "_raw"
_BINARY = "path string, modificationTime timestamp, length long, content binary"


def landing_files(spark: SparkSession, landing_base: str, entity: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of newly arrived landing files ``(path, length)`` for one entity."""
    r = (spark.readStream.format("binaryFile").schema(_BINARY)
              .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(f"{landing_base.rstrip('/')}/{entity}").select("path", "length")


def _declared(spark, paths, entity) -> DataFrame:
    return (spark.read.schema(LANDING[entity]).parquet(*paths)
                 .withColumn("_file_path", F.col("_metadata.file_path")))


def _own_schema(spark, paths, entity) -> DataFrame:
    """Foreign files of one schema read with it, cast to the declared landing types."""
    df = spark.read.parquet(*paths)
    cols, have = [], set(df.columns)
    for f in LANDING[entity].fields:
        if f.name in have:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, F.col("_metadata.file_path").alias("_file_path"))


def _compatible(schema, entity) -> bool:
    have = {f.name: f.dataType for f in schema.fields}
    return all(have.get(f.name, f.dataType) == f.dataType for f in LANDING[entity].fields)


def _to_raw_with_losses(landing: DataFrame, entity: str) -> DataFrame:
    """Raw-typed columns, the row's file, and ``_lost``: the columns whose non-null value the cast made null."""
    loaded_at = F.localtimestamp()
    raw_cols, lost = [], []
    types = dict(landing.dtypes)
    for f in RAW[entity].fields:
        if f.name == "_loaded_at":
            raw_cols.append(loaded_at.alias("_loaded_at"))
            continue
        if f.name not in types:
            raw_cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if f.dataType.typeName() == "timestamp_ntz" and types[f.name] == "string":
            v = c.try_cast("timestamp").cast("timestamp_ntz")   # ISO strings with offsets
        else:
            v = c.try_cast(f.dataType)
        raw_cols.append(v.alias(f.name))
        if types[f.name] != f.dataType.simpleString():           # a cast to its own type loses nothing
            lost.append(F.when(c.isNotNull() & v.isNull(), F.lit(f.name)))
    any_lost = F.coalesce(*lost) if lost else F.lit(None).cast("string")      # mostly null: no array is made
    names = F.array_compact(F.array(*lost)) if lost else F.lit(None).cast("array<string>")
    return landing.select(*raw_cols, F.col("_file_path").alias(FILE_COL), F.when(any_lost.isNotNull(), names).alias(LOST_COL))


def _append(df: DataFrame, stream_id: str, batch_id: int, path: str) -> None:
    """Write the partition of this stream and micro-batch, replacing only a replay of itself.

    The folder is named here: a write partitioned by columns sorts all rows by them, though they have one value.
    """
    df.write.mode("overwrite").parquet(_batch_folder(path, stream_id, batch_id))


def _history(rows: DataFrame, entity: str, files: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per arrived file: those without data rows and those that failed included."""
    lost_cols = [f"_lost__{f.name}" for f in RAW[entity].fields]
    # per column: how many non-null inputs the cast turned into null, e.g. "hire_date=3"
    detail = F.concat_ws(", ", *[F.when(F.col(c) > 0, F.concat(F.lit(c[len("_lost__"):] + "="), F.col(c)))
                                 for c in lost_cols])
    seen = (rows.groupBy(bare_path(F.col(FILE_COL)).alias("_seen"))
                .agg(F.count(F.lit(1)).alias("rows"), F.count(LOST_COL).alias("lost"),
                     *[F.count_if(F.array_contains(LOST_COL, c[len("_lost__"):])).alias(c) for c in lost_cols]))
    lost = F.coalesce(F.col("lost"), F.lit(0)) > 0
    n = F.coalesce(F.col("rows"), F.lit(0)).cast("bigint")
    return (files.join(seen, bare_path(F.col("path")) == F.col("_seen"), "left")
                 .join(failed.withColumnRenamed("path", "_failed"), F.col("path") == F.col("_failed"), "left")
                 .select(F.col("path").alias("file_name"), F.col("length").alias("file_size"),
                         n.alias("row_count"), n.alias("row_parsed"),
                         F.coalesce("error", F.when(lost, F.concat(F.lit("values lost in cast: "), detail)))
                          .alias("first_error_message"),
                         F.when(F.col("_failed").isNotNull(), F.lit("LOAD_FAILED"))
                          .when(lost, F.lit("PARTIALLY_LOADED")).otherwise(F.lit("LOADED")).alias("status"),
                         F.localtimestamp().alias("last_load_time")))


def _batch_folder(table: str, stream_id: str, batch_id: int | str) -> str:
    return f"{table.rstrip('/')}/{STREAM_COL}={stream_id}/{BATCH_COL}={batch_id}"


def _finish(spark: SparkSession, raw_path: str, history_path: str, stream_id: str, batch_id: int) -> None:
    """Make a batch current in both tables: its manifest appears at once, or not."""
    raw = raw_path.rstrip("/")
    create_text(spark, f"{history_path.rstrip('/')}/{_RAW_OF}", raw)      # where the history's manifests lie
    create_text(spark, f"{raw}/{_MANIFESTS}/{stream_id}.{batch_id}", "")


def _finished(spark: SparkSession, raw_path: str) -> list[str]:
    """``stream id.batch id`` of the batches that are current."""
    return [f.rsplit("/", 1)[-1] for f in list_files(spark, f"{raw_path.rstrip('/')}/{_MANIFESTS}")]


def _finished_folders(spark: SparkSession, raw_path: str, table: str) -> list[str]:
    folders = [_batch_folder(table, *name.rsplit(".", 1)) for name in _finished(spark, raw_path)]
    return [f for f in folders if path_exists(spark, f)]                  # a batch without rows has no folder


def _is_file_fault(exc: Exception) -> bool:
    """Whether an error says that a file's footer or column types are not what was declared.

    Everything else (a storage error, a lost executor, a full disk) is raised: the batch
    then fails as a whole and the stream reads its files again.
    """
    text = str(exc)
    return any(x in text for x in _FILE_FAULTS)


_FILE_FAULTS = ("PARQUET_COLUMN_DATA_TYPE_MISMATCH", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file",
                "UNABLE_TO_INFER_SCHEMA", "SchemaColumnConvertNotSupportedException", "CANNOT_MERGE_SCHEMAS")


def _footers(spark: SparkSession, paths: list[str]) -> tuple[dict[str, object], list[tuple[str, str]]]:
    """Schema of each readable file, and (path, error) of the others; footers are read side by side."""
    from concurrent.futures import ThreadPoolExecutor

    def one(path):
        try:
            return path, spark.read.parquet(path).schema, None
        except Exception as exc:
            if not _is_file_fault(exc):
                raise
            return path, None, str(exc) or repr(exc)

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        read = list(pool.map(one, paths))
    return {p: s for p, s, e in read if e is None}, [(p, e) for p, s, e in read if e is not None]


def write_batch(files: DataFrame, batch_id: int, entity: str, raw_path: str,
                history_path: str, stream_id: str = "stream") -> None:
    """Load one micro-batch of landing files (idempotent per stream and ``batch_id``)."""
    spark = files.sparkSession
    if f"{stream_id}.{batch_id}" in _finished(spark, raw_path):
        return                         # replayed after it was finished: both tables have it
    # file metadata only: at most maxFilesPerTrigger (path, size) pairs
    listed = [(r["path"], r["length"]) for r in files.collect()]
    if not listed:
        return
    paths = sorted(p for p, _ in listed)
    known = spark.createDataFrame(listed, "path string, length long")
    no_failure = spark.createDataFrame([], "path string, error string")

    def load(landing: DataFrame, failed: DataFrame) -> None:
        # clustered: sorted on the common filter columns so row-group min/max prune scans
        out = _to_raw_with_losses(landing, entity).sortWithinPartitions(*RAW_CLUSTER[entity])
        _append(out, stream_id, batch_id, raw_path)
        there = _batch_folder(raw_path, stream_id, batch_id)
        notes = out.select(FILE_COL, LOST_COL)
        rows = (spark.read.schema(notes.schema).parquet(there) if path_exists(spark, there)
                else spark.createDataFrame([], notes.schema))     # no file had a row
        _append(_history(rows, entity, known, failed), stream_id, batch_id, history_path)
        _finish(spark, raw_path, history_path, stream_id, batch_id)

    try:
        return load(_declared(spark, paths, entity), no_failure)
    except Exception as exc:
        if not _is_file_fault(exc):
            raise
    # some footer disagrees with the declared schema: sort the files by what they hold
    schemas, failed = _footers(spark, paths)
    good = [p for p in paths if p in schemas and _compatible(schemas[p], entity)]
    foreign: dict[str, list[str]] = {}
    for p in paths:
        if p in schemas and p not in good:
            foreign.setdefault(schemas[p].json(), []).append(p)
    landing = (_declared(spark, good, entity) if good else
               spark.createDataFrame([], LANDING[entity]).withColumn("_file_path", F.lit(None).cast("string")))
    for same in foreign.values():
        landing = landing.unionByName(_own_schema(spark, same, entity))
    load(landing, spark.createDataFrame(failed, "path string, error string") if failed else no_failure)


MAX_FILES_PER_BATCH = 10_000
FOOTER_THREADS = 16


def ingest_stream(spark: SparkSession, landing_base: str, entity: str, raw_path: str,
                  history_path: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None,
                  max_files_per_trigger: int | None = MAX_FILES_PER_BATCH) -> StreamingQuery:
    """Start the ingest stream; ``available_now`` drains what is there and stops (nightly),
    otherwise it polls every ``processing_time`` (continuous).

    ``max_files_per_trigger`` bounds each micro-batch (and the file list its
    driver-side batch function sees); ``availableNow`` still drains everything,
    in as many batches as needed.  Rows are filed under the stream's own id, which
    its checkpoint keeps: a stream with a new checkpoint adds to the tables.
    """
    stream = []

    def batch(files: DataFrame, batch_id: int) -> None:
        if not stream:      # the checkpoint's metadata file holds the id that restarts of this stream share
            stream.append(json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata").splitlines()[0])["id"])
        write_batch(files, batch_id, entity, raw_path, history_path, stream[0])

    w = (landing_files(spark, landing_base, entity, max_files_per_trigger or MAX_FILES_PER_BATCH).writeStream
         .foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .queryName(f"ingest_{entity}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()


def read_raw(spark: SparkSession, raw_path: str, entity: str) -> DataFrame:
    """The raw table (all finished micro-batches), declared schema."""
    folders = _finished_folders(spark, raw_path, raw_path)
    if not folders:
        return spark.createDataFrame([], RAW[entity])
    return spark.read.schema(RAW[entity]).parquet(*folders).select(
        *[f.name for f in RAW[entity].fields])


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """Per-file load history of the finished batches (``_stream_id`` and ``_batch_id`` are its partitions)."""
    marker = f"{history_path.rstrip('/')}/{_RAW_OF}"
    folders = _finished_folders(spark, read_text(spark, marker), history_path) if path_exists(spark, marker) else []
    if not folders:
        return spark.createDataFrame([], LOAD_HISTORY).withColumns(
            {STREAM_COL: F.lit(None).cast("string"), BATCH_COL: F.lit(None).cast("int")})
    return spark.read.option("basePath", history_path).parquet(*folders).select(
        *[F.col(f.name).cast(f.dataType) for f in LOAD_HISTORY.fields], STREAM_COL, BATCH_COL)


def recent_loads(hist: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Per-file load history of the last ``hours`` hours, newest first."""
    since = F.timestamp_add("HOUR", F.lit(-hours), as_timestamp(as_of))
    return (hist.where(F.col("last_load_time") >= since)
                .select("file_name", "file_size", "row_count", "row_parsed",
                        "first_error_message", "status", "last_load_time")
                .orderBy(F.col("last_load_time").desc()))


def load_failures(hist: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Files whose load failed in the last ``days`` days, newest first."""
    since = F.timestamp_add("DAY", F.lit(-days), as_timestamp(as_of))
    return (hist.where((F.col("status") == "LOAD_FAILED") & (F.col("last_load_time") >= since))
                .select("file_name", "first_error_message", "last_load_time")
                .orderBy(F.col("last_load_time").desc()))
