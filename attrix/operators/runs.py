"""Run log: append-only audit of ingestion runs and the queries over it.

The log is an append-only Parquet table; state (the last successful date) is
an aggregate over it, never a mutable row.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from attrix.functions.dates import as_date, as_timestamp, hours_between, seconds_between
from attrix.schema import RUNS
from attrix.session import create_text, list_files, read_text, remove_path, stored_bytes


def record_run(spark: SparkSession, runs_path: str, entity: str, run_date, records_staged: int,
               status: str, started_at: _dt.datetime, keys=None, error_message: str | None = None,
               completed_at: _dt.datetime | None = None) -> str:
    """Append one run record and return its id (a single small metadata row)."""
    run_id = str(uuid.uuid4())
    completed_at = completed_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = (run_id, as_py_date(run_date), entity, int(records_staged),
           None if keys is None else json.dumps(list(keys)), status,
           started_at.replace(tzinfo=None), completed_at, error_message)
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(runs_path)
    return run_id


def as_py_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


_COMPACTED = "_compacted"


def _checkpoint(spark: SparkSession, runs_path: str) -> tuple[int, dict]:
    """The newest compaction: its number, its folder of run records, and the files that these came from."""
    found = list_files(spark, f"{runs_path.rstrip('/')}/{_COMPACTED}")
    if not found:
        return 0, {"folder": None, "covers": []}
    newest = max(found, key=lambda f: int(f.rsplit("/", 1)[-1]))
    return int(newest.rsplit("/", 1)[-1]), json.loads(read_text(spark, newest))


def _tail(spark: SparkSession, runs_path: str, covers: list[str]) -> list[str]:
    """Record files that the compaction with ``covers`` does not hold yet."""
    return [f for f in list_files(spark, runs_path) if f.endswith(".parquet") and f.rsplit("/", 1)[-1] not in covers]


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    """All run records, each once: those of the newest compaction and the files written since."""
    _, at = _checkpoint(spark, runs_path)
    paths = _tail(spark, runs_path, at["covers"])
    if at["folder"]:
        paths.append(f"{runs_path.rstrip('/')}/{at['folder']}")
    return spark.read.schema(RUNS).parquet(*paths) if paths else spark.createDataFrame([], RUNS)


FILE_BYTES = 64 << 20      # of a gathered file; a task reads its rows uncompressed, some three times that


def compact_runs(spark: SparkSession, runs_path: str, files: int = 1, file_bytes: int = FILE_BYTES) -> int:
    """Gather the record files into ``files`` files, or more of about ``file_bytes``; returns how many were gathered.

    A manifest, ``_compacted/<n>``, names the gathered folder and the files it came from; it
    appears last and at once, so a reader sees each run in one place.  Gathered files, and the
    folder before, are removed by the *next* compaction, when nobody who starts reading needs
    them; a record that is appended meanwhile is in the tail.  Of two compactions at a time one
    gives up.  So the number of files depends on the records' bytes, not on how many runs wrote them.
    """
    base = runs_path.rstrip("/")
    number, at = _checkpoint(spark, runs_path)
    listed = {f.rsplit("/", 1)[-1] for f in list_files(spark, runs_path)}
    new, old = _tail(spark, runs_path, at["covers"]), [f for f in at["covers"] if f in listed]
    if not new:
        return 0
    folder = f"{_COMPACTED}_data-{uuid.uuid4().hex[:12]}"
    paths = [*new, f"{base}/{at['folder']}"] if at["folder"] else new
    files = max(files, -(-stored_bytes(spark, paths) // file_bytes))
    (spark.read.schema(RUNS).parquet(*paths).repartitionByRange(files, "run_date", "started_at", "run_id")
     .write.parquet(f"{base}/{folder}"))
    manifest = {"folder": folder, "covers": [f.rsplit("/", 1)[-1] for f in new] + old, "before": at["folder"]}
    if not create_text(spark, f"{base}/{_COMPACTED}/{number + 1:012d}", json.dumps(manifest)):
        remove_path(spark, f"{base}/{folder}")
        return 0
    for gone in old:
        remove_path(spark, f"{base}/{gone}")
    if at.get("before"):
        remove_path(spark, f"{base}/{at['before']}")
    for f in list_files(spark, f"{base}/{_COMPACTED}"):
        if int(f.rsplit("/", 1)[-1]) < number:
            remove_path(spark, f)
    return len(new)


def _success(runs: DataFrame, entity: str | None = None) -> DataFrame:
    c = F.col("status") == "SUCCESS"
    if entity is not None:
        c = c & (F.col("entity") == F.lit(entity))
    return runs.where(c)


def last_loaded_date(runs: DataFrame, entity: str = "terminations") -> DataFrame:
    """One row: the latest successful ``run_date`` of ``entity`` (null when none)."""
    return _success(runs, entity).agg(F.max("run_date").alias("last_run_date"))


def last_success_at(runs: DataFrame, entity: str = "terminations") -> DataFrame:
    return _success(runs, entity).agg(F.max("completed_at").alias("last_success_at"))


def last_success(runs: DataFrame) -> DataFrame:
    """Latest successful run date and completion time per entity."""
    return (_success(runs).groupBy("entity")
            .agg(F.max("run_date").alias("last_success_date"),
                 F.max("completed_at").alias("last_success_at"))
            .orderBy("entity"))


def run_history(runs: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Runs of the last ``days`` days, newest first, with duration in seconds."""
    since = F.date_sub(as_date(_day(as_of)), days)
    return (runs.where(F.col("run_date") >= since)
            .select("run_date", "entity", "status", "records_staged", "started_at", "completed_at",
                    seconds_between("started_at", "completed_at").alias("duration_seconds"),
                    "error_message")
            .orderBy(F.col("started_at").desc()))


def failed_runs(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    since = F.date_sub(as_date(_day(as_of)), days)
    return (runs.where((F.col("status") == "FAILED") & (F.col("run_date") >= since))
            .select("run_date", "entity", "error_message", "started_at")
            .orderBy(F.col("started_at").desc()))


def daily_volume(runs: DataFrame, entity: str = "terminations",
                 out: str = "terminations_staged") -> DataFrame:
    return (_success(runs, entity).groupBy("run_date")
            .agg(F.sum("records_staged").alias(out))
            .orderBy(F.col("run_date").desc()))


def resolve_window(runs: DataFrame, as_of, start=None, end=None, full_load: bool = False,
                   entity: str = "terminations", fallback_days: int = 30,
                   lookback_days: int = 0) -> DataFrame:
    """The incremental window as one row ``(start_date, end_date, source, is_empty)``.

    start: explicit override → none when ``full_load`` → day after the last
    successful run → ``fallback_days`` before ``as_of``. end: override or
    ``as_of``. A window whose start is after its end is flagged ``is_empty``
    (a second run on the same day extracts nothing instead of failing).
    ``lookback_days`` re-reads that many days before the derived start, so an
    exit entered after its own date is still picked up (re-read records are
    removed again by de-duplication in staging).
    """
    day = as_date(_day(as_of))
    end_c = as_date(end) if end is not None else day
    last = last_loaded_date(runs, entity)
    if start is not None:
        s, src = as_date(start), F.lit("override")
    elif full_load:
        s, src = F.lit(None).cast("date"), F.lit("full_load")
    else:
        lr = F.col("last_run_date")
        s = F.coalesce(F.date_add(lr, 1 - lookback_days), F.date_sub(day, fallback_days))
        src = F.when(lr.isNotNull(), F.lit("last_success")).otherwise(F.lit("fallback"))
    return last.select(s.alias("start_date"), end_c.alias("end_date"), src.alias("source"),
                       F.coalesce(s > end_c, F.lit(False)).alias("is_empty"))


def _day(as_of):
    if isinstance(as_of, str):
        return as_of[:10]
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    return as_of


def ran_recently(runs: DataFrame, as_of, entity: str = "terminations", hours: int = 25) -> DataFrame:
    """Failing row when ``entity`` had no success within ``hours`` of ``as_of`` (or never)."""
    now = as_timestamp(as_of)
    h = hours_between("last_success_at", now)
    return (last_success_at(runs, entity)
            .select("last_success_at", now.alias("checked_at"), h.alias("hours_since_last_run"),
                    F.lit(f"Pipeline has not run successfully in the last {hours} hours")
                     .alias("failure_reason"),
                    (F.col("last_success_at").isNull() | (h > hours)).alias("_stale"))
            .where("_stale").drop("_stale"))
