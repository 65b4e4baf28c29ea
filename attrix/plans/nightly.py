"""The nightly run: resolve the window, stage both entities, log each run.

``run_ingest`` is a driver-side orchestration of distributed steps (each stage
is one Spark write); the only values that come back to the driver are the
observed row/page totals and one aggregate (the last successful run date).
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession

from attrix.operators import filters as FL, runs as RN
from attrix.session import bare_path, path_exists
from attrix.sources.landing import stage

log = logging.getLogger(__name__)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _confirm_load(spark: SparkSession, landing_base: str, summary: dict, confirm_with: dict) -> None:
    """Load the entity's new files now and require exactly this run's files in the load history."""
    from pyspark.sql import functions as F
    from attrix.streaming.ingest import ingest_stream, read_history
    entity = summary["entity"]
    hist = f"{confirm_with['history']}/{entity}"
    ingest_stream(spark, landing_base, entity, f"{confirm_with['raw']}/{entity}", hist,
                  f"{confirm_with['checkpoint']}/{entity}").awaitTermination()
    if not summary["records"]:
        return
    files = spark.createDataFrame([(bare_path(f),) for f in summary["files"]], "_f string")
    loaded = 0
    if path_exists(spark, hist):
        loaded = (read_history(spark, hist).where(F.col("status") != "LOAD_FAILED")
                  .join(files, bare_path(F.col("file_name")) == F.col("_f"), "left_semi")
                  .agg(F.sum("row_parsed")).first()[0] or 0)
    if loaded < summary["records"]:
        raise RuntimeError(f"{entity}: staged {summary['records']} records but the load history "
                           f"confirms {loaded}")


def run_ingest(spark: SparkSession, employees: DataFrame, terminations: DataFrame,
               landing_base: str, runs_path: str, run_date=None, start_date=None,
               end_date=None, full_load: bool = False, as_of=None,
               lookback_days: int = 0, confirm_with: dict | None = None) -> dict:
    """Stage all employees and the terminations of the incremental window.

    Window: explicit ``start_date`` → none when ``full_load`` → day after the
    last successful terminations run → 30 days back; end: ``end_date`` or the
    run date. A window that starts after it ends stages nothing. Each entity
    appends a SUCCESS row to the run log; a failure appends one FAILED row for
    entity ``pipeline`` and re-raises.

    ``confirm_with`` (``{"raw": …, "history": …, "checkpoint": …}``) makes SUCCESS
    mean *loaded*, not just staged: each entity's new files are ingested right
    away and the load history must account for every staged record, otherwise
    the run fails (and the next run's window starts from the last confirmed day).
    """
    run_date = RN.as_py_date(run_date or _dt.date.today())
    as_of = as_of or run_date
    try:
        FL.validate_window(start_date, end_date, as_of)
        if path_exists(spark, runs_path):
            runs = RN.read_runs(spark, runs_path)
            win = RN.resolve_window(runs, str(run_date), start_date, end_date, full_load,
                                    lookback_days=lookback_days).first()
            start, end, empty = win["start_date"], win["end_date"], win["is_empty"]
        else:
            start = (RN.as_py_date(start_date) if start_date else
                     None if full_load else run_date - _dt.timedelta(days=30))
            end = RN.as_py_date(end_date) if end_date else run_date
            empty = bool(start and start > end)
        log.info("incremental window %s → %s (full_load=%s)", start, end, full_load)

        started = _now()
        emp = stage(FL.filter_status(employees, "All"), "employees", run_date, landing_base)
        if confirm_with:
            _confirm_load(spark, landing_base, emp, confirm_with)
        RN.record_run(spark, runs_path, "employees", run_date, emp["records"], "SUCCESS",
                      started, keys=emp["files"])

        started = _now()
        if empty:
            term = {"entity": "terminations", "records": 0, "pages": 0, "path": None, "files": []}
        else:
            windowed = FL.filter_window(terminations.withColumn(
                "_td", terminations["termination_date"].cast("date")), "_td", start, end).drop("_td")
            term = stage(windowed, "terminations", run_date, landing_base)
        if confirm_with:
            _confirm_load(spark, landing_base, term, confirm_with)
        RN.record_run(spark, runs_path, "terminations", run_date, term["records"], "SUCCESS",
                      started, keys=term["files"])
        return {"status": "SUCCESS", "run_date": str(run_date),
                "incremental_window": {"start": str(start), "end": str(end)},
                "employees": emp, "terminations": term}
    except Exception as exc:
        try:
            RN.record_run(spark, runs_path, "pipeline", run_date, 0, "FAILED", _now(),
                          error_message=str(exc))
        except Exception as audit_exc:  # the original error matters more
            log.error("could not write FAILED run record: %s", audit_exc)
        raise
