"""Named queries over the driver tables (the repository's query catalogue).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame that reads the
driver tables through the adapters in ``attrix.sources.adapters``.
"""

from __future__ import annotations

import datetime as _dt
import functools
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from attrix.functions.dates import active_on, as_timestamp
from attrix.operators import filters as FL, quality as Q, runs as RN
from attrix.operators.asof import asof_headcount
from attrix.operators.dedup import latest_per_key
from attrix.operators.headcount import (headcount_rows, month_spine, monthly_combined, monthly_exits,
                                        monthly_headcount)
from attrix.operators.joins import lifecycle
from attrix.operators.rolling import rolling_turnover
from attrix.plans.build import bucketed, build, lookup_ready, written
from attrix.plans.check_state import update_checks
from attrix.plans.dashboard import exits, turnover
from attrix.plans.incremental import update_mart
from attrix.plans.marts import dim_employees, fct_terminations
from attrix.plans.nightly import run_ingest
from attrix.plans.staging import ORDER, stage_employees, stage_terminations
from attrix.plans.suite import business_rules, suite
from attrix.schema import API_TERMINATION, LANDING, RAW_CLUSTER, TERMINATION_TYPES
from attrix.session import bare_path, ensure_conf, list_files, move_file, path_exists, scratch_path
from attrix.sources import adapters as A
from attrix.sources.landing import (api_records, cluster_for_write, coerce_dates, lost_dates, read_landing, read_report_json,
                                    stage, with_lineage, with_page_numbers)
from attrix.sources.versioned import Store
from attrix.streaming.ingest import (ingest_stream, load_failures, read_history, read_raw,
                                     recent_loads)

Query = Callable[[SparkSession, str], DataFrame]


def _hr(spark: SparkSession, sf_dir: str):
    ensure_conf(spark)
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    stg_e = stage_employees(raw_e, A.ORDERS_AS_OF)
    stg_t = stage_terminations(raw_t)
    dim = dim_employees(stg_e)
    fct = fct_terminations(stg_t, dim)
    return stg_e, stg_t, dim, fct


def q_stage_employees(spark, sf_dir):
    return _hr(spark, sf_dir)[0]


def q_stage_terminations(spark, sf_dir):
    return _hr(spark, sf_dir)[1]


def q_dim_employees(spark, sf_dir):
    return _hr(spark, sf_dir)[2]


def q_fct_terminations(spark, sf_dir):
    return _hr(spark, sf_dir)[3]


def q_lifecycle(spark, sf_dir):
    _, _, dim, fct = _hr(spark, sf_dir)
    return lifecycle(dim, fct)


def q_monthly_headcount(spark, sf_dir):
    _, _, dim, fct = _hr(spark, sf_dir)
    return _headcount(dim, fct)


def _headcount(dim, fct):
    return monthly_headcount(headcount_rows(dim, fct), A.ORDERS_SPINE_START, A.ORDERS_AS_OF, weight="weight")


def q_month_spine(spark, sf_dir):
    """The months from the first to before the last order's, a row each."""
    ensure_conf(spark)
    span = A.table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("a"),
                                                F.max("o_orderdate").cast("date").alias("b")).first()
    return month_spine(spark, span["a"], span["b"])


def q_headcount_orders(spark, sf_dir):
    """End-of-month headcount over orders read directly as lifecycles (headcount alone)."""
    ensure_conf(spark)
    life = A.order_lifecycles(A.table(spark, sf_dir, "orders"))
    return monthly_headcount(life, A.ORDERS_SPINE_START, A.ORDERS_AS_OF)


def q_active_on(spark, sf_dir):
    """Orders, read as lifecycles, that are active on one day."""
    ensure_conf(spark)
    return A.order_lifecycles(A.table(spark, sf_dir, "orders")).where(active_on(F.lit("1998-06-30").cast("date")))


def q_monthly_exits(spark, sf_dir):
    return monthly_exits(_hr(spark, sf_dir)[3])


def q_monthly_combined(spark, sf_dir):
    _, _, dim, fct = _hr(spark, sf_dir)
    return monthly_combined(_headcount(dim, fct), monthly_exits(fct))


def q_rolling_turnover(spark, sf_dir):
    _, _, dim, fct = _hr(spark, sf_dir)
    return _turnover(dim, fct)


def _turnover(dim, fct):
    return rolling_turnover(monthly_combined(_headcount(dim, fct), monthly_exits(fct)), as_of=A.ORDERS_AS_OF)


def _models(spark, sf_dir):
    stg_e, stg_t, dim, fct = _hr(spark, sf_dir)
    return {"stg_employees": stg_e, "stg_terminations": stg_t, "dim_employees": dim,
            "fct_terminations": fct, "turnover": _turnover(dim, fct)}


def _runs(spark, sf_dir):
    ensure_conf(spark)
    return A.runs_from_events(A.table(spark, sf_dir, "events"))


# -- generic top-1 per key on real duplicates ---------------------------------------

def q_latest_per_key(spark, sf_dir):
    """Latest shipment per (order, line) — the lineitem key repeats in the data."""
    ensure_conf(spark)
    li = A.table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# -- filters / paging / lookup -------------------------------------------------------

def q_filter_terminations(spark, sf_dir):
    t = _hr(spark, sf_dir)[1]
    return FL.filter_type(FL.filter_window(t, "termination_date", "1998-01-01", "1998-12-31"),
                          "VOLUNTARY")


def q_filter_status(spark, sf_dir):
    return FL.filter_status(_hr(spark, sf_dir)[0], "TERMINATED")


def q_page(spark, sf_dir):
    return FL.page(_hr(spark, sf_dir)[0], ["employee_id"], limit=100, offset=200)


def q_page_deep(spark, sf_dir):
    """500 rows from three fifths down the line items, under a key that repeats and is null in places."""
    ensure_conf(spark)
    li = A.table(spark, sf_dir, "lineitem")
    keyed = li.select(F.when(F.col("l_quantity") <= 40, F.col("l_linenumber")).alias("k"), *li.columns)
    return FL.page(keyed, ["k"], limit=500, offset=3 * li.count() // 5)


def q_lookup(spark, sf_dir):
    return FL.lookup(_hr(spark, sf_dir)[2], "employee_id", "E1", hashed_key="employee_key")


def q_exits_drill(spark, sf_dir):
    """Dashboard drill-through: one state's exits in one month."""
    return exits(_hr(spark, sf_dir)[3], "1-URGENT", "1998-06-01")


def q_dashboard_turnover(spark, sf_dir):
    """The mart written as a table and read for one state."""
    _, _, dim, fct = _hr(spark, sf_dir)
    path = scratch_path(spark, "mart")
    _turnover(dim, fct).write.parquet(path)
    return turnover(spark, path, "1-URGENT")


# -- run log ---------------------------------------------------------------------------

def q_last_success(spark, sf_dir):
    return RN.last_success(_runs(spark, sf_dir))


def q_last_loaded_date(spark, sf_dir):
    return RN.last_loaded_date(_runs(spark, sf_dir), "terminations")


def q_run_history(spark, sf_dir):
    return RN.run_history(_runs(spark, sf_dir), A.EVENTS_AS_OF, days=30)


def q_failed_runs(spark, sf_dir):
    return RN.failed_runs(_runs(spark, sf_dir), A.EVENTS_AS_OF, days=7)


def q_daily_volume(spark, sf_dir):
    return RN.daily_volume(_runs(spark, sf_dir), "terminations")


def q_resolve_window(spark, sf_dir):
    return RN.resolve_window(_runs(spark, sf_dir), A.EVENTS_AS_OF)


def q_resolve_window_override(spark, sf_dir):
    return RN.resolve_window(_runs(spark, sf_dir), A.EVENTS_AS_OF, start="2024-01-05", end="2024-01-09")


def q_resolve_window_full(spark, sf_dir):
    return RN.resolve_window(_runs(spark, sf_dir), A.EVENTS_AS_OF, full_load=True)


def q_resolve_window_first_run(spark, sf_dir):
    """An entity without a successful run: thirty days back."""
    return RN.resolve_window(_runs(spark, sf_dir), A.EVENTS_AS_OF, entity="pipeline")


# -- data quality ------------------------------------------------------------------------

def q_dq_unique(spark, sf_dir):
    """Raw termination ids repeat (re-loads) — the reason staging de-duplicates."""
    return Q.unique(A.hr_inputs(spark, sf_dir)[1], "termination_id")


def q_dq_not_null(spark, sf_dir):
    """Exits of employees that the dimension (here: without one priority's orders) does not know."""
    _, stg_t, dim, _ = _hr(spark, sf_dir)
    return Q.not_null(fct_terminations(stg_t, _without_urgent(dim)), "location_state")


def _without_urgent(dim):
    return dim.where(F.col("location_state") != "1-URGENT")


def q_dq_accepted_values(spark, sf_dir):
    """Raw (uncleaned) termination types against the controlled list."""
    return Q.accepted_values(A.hr_inputs(spark, sf_dir)[1], "termination_type", TERMINATION_TYPES)


def q_dq_relationships(spark, sf_dir):
    dim = _hr(spark, sf_dir)[2]
    return Q.relationships(dim, "manager_id", _without_urgent(dim), "employee_id")


def q_dq_not_in_future(spark, sf_dir):
    return Q.not_in_future(_hr(spark, sf_dir)[0], "hire_date", "1994-06-30")


def q_dq_not_before_column(spark, sf_dir):
    return Q.termination_after_hire(_hr(spark, sf_dir)[3])


def q_dq_is_between(spark, sf_dir):
    return Q.is_between(_models(spark, sf_dir)["turnover"], "rolling_12m_turnover_rate", 0, 5)


def q_dq_ran_recently(spark, sf_dir):
    return RN.ran_recently(_runs(spark, sf_dir), "2024-02-01 01:30:00", "terminations", 25)


def q_dq_freshness(spark, sf_dir):
    """Both sources at a fixed time, and terminations 25 hours 50 minutes after the newest row."""
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    newest = raw_t.agg(F.max("_pipeline_written_at")).first()[0]
    late = newest + _dt.timedelta(hours=25, minutes=50)
    cases = [("terminations", raw_t, "2001-11-06 12:00:00"), ("employees", raw_e, "2002-01-01 02:30:00"),
             ("terminations_late", raw_t, late)]
    parts = [Q.freshness(df, "_pipeline_written_at", now).select(F.lit(name).alias("source"), "*") for name, df, now in cases]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_dq_terminated_without_exit(spark, sf_dir):
    _, _, dim, fct = _hr(spark, sf_dir)
    return Q.terminated_without_exit(dim, fct)


def q_dq_spine_contiguous(spark, sf_dir):
    """The mart without its Junes: every July follows a gap."""
    return Q.spine_contiguous(_models(spark, sf_dir)["turnover"].where(F.month("month_start") != 6))


def q_dq_suite(spark, sf_dir):
    # Materialise each model once in the shared checkpoint folder; the suite
    # then scans five small tables instead of re-deriving them per check. Three of them leave a
    # shuffle on the employee key, so they are bucketed on it at no cost, and what joins them or
    # groups them by that key does not shuffle them again.
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    store = bucketed(spark, scratch_path(spark, "models"), int(spark.conf.get("spark.sql.shuffle.partitions")),
                     keyed=("stg_employees", "dim_employees", "fct_terminations"))
    models = build(raw_e, raw_t, A.ORDERS_AS_OF, A.ORDERS_SPINE_START, materialize=store, materialize_staging=True)
    rules = business_rules(models, _runs(spark, sf_dir), SUITE_NOW)
    return Q.run_suite(suite(A.ORDERS_AS_OF), models, rules)


SUITE_NOW = "2024-02-01 01:30:00"


# -- landing, streaming ingest, report JSON, nightly run ------------------------------

STAGE_RUN_DATE = "2001-11-05"
STAGE_WRITTEN_AT = "2001-11-05 02:00:00"


def _api_terminations(spark, sf_dir):
    return api_records(A.hr_inputs(spark, sf_dir)[1], "terminations")


def _staged(spark, sf_dir):
    base = scratch_path(spark, "landing")
    stage(_api_terminations(spark, sf_dir), "terminations", STAGE_RUN_DATE, base,
          written_at=STAGE_WRITTEN_AT)
    return base


def q_stage_parquet(spark, sf_dir):
    """Stage terminations as paged, date-partitioned landing Parquet; read it back."""
    return read_landing(spark, _staged(spark, sf_dir), "terminations")


def _ingested(spark, sf_dir, entity="terminations"):
    return _ingest(spark, _staged(spark, sf_dir) if entity == "terminations" else _staged_employees(spark, sf_dir), entity)


def _later():
    """A little after now: the history's load times lie before it."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None) + _dt.timedelta(minutes=5)


def _ingest(spark, landing, entity):
    out = scratch_path(spark, "raw")
    q = ingest_stream(spark, landing, entity, f"{out}/raw", f"{out}/history",
                      f"{out}/checkpoint")
    q.awaitTermination()
    return out


def _staged_employees(spark, sf_dir):
    base = scratch_path(spark, "landing")
    stage(api_records(A.hr_inputs(spark, sf_dir)[0], "employees"), "employees", STAGE_RUN_DATE,
          base, written_at=STAGE_WRITTEN_AT)
    return base


def q_ingest_employees(spark, sf_dir):
    """Employee snapshots: landing → raw through the file stream."""
    out = _ingested(spark, sf_dir, "employees")
    return read_raw(spark, f"{out}/raw", "employees").drop("_loaded_at")


def q_recent_loads(spark, sf_dir):
    """Files loaded in the last 24 hours (as of now): file and row totals per status."""
    h = read_history(spark, f"{_ingested(spark, sf_dir)}/history")
    return (recent_loads(h, _later(), 24).groupBy("status")
            .agg(F.sum("row_count").alias("row_count")))


def q_ingest_stream(spark, sf_dir):
    """Landing files → raw table through an availableNow file stream."""
    out = _ingested(spark, sf_dir)
    return read_raw(spark, f"{out}/raw", "terminations").drop("_loaded_at")


def q_load_history(spark, sf_dir):
    """The load history against the landing itself: per status its rows, files that it lacks or has twice, wrong sizes."""
    base = _staged(spark, sf_dir)
    out = _ingest(spark, base, "terminations")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(f"{base}/terminations").select(bare_path(F.col("path")).alias("f"), "length"))
    h = read_history(spark, f"{out}/history").withColumn("h", bare_path(F.col("file_name")))
    j = listed.join(h, F.col("f") == F.col("h"), "full")
    return j.groupBy("status").agg(
        F.sum("row_count").alias("row_count"), F.sum("row_parsed").alias("row_parsed"),
        (F.count("*") - F.count_distinct("f", "h")).alias("files_wrong"),
        F.count_if(F.col("file_size").isNull() | (F.col("file_size") != F.col("length"))).alias("sizes_wrong"))


def q_load_failures(spark, sf_dir):
    """A batch with a broken file and one without rows beside the staged ones: its history, staged files summed."""
    base = _staged(spark, sf_dir)
    day = f"{base}/terminations/year=2001/month=11/day=06"
    terms = _api_terminations(spark, sf_dir)
    odd = scratch_path(spark, "odd")
    terms.select("termination_id").orderBy("termination_id").limit(3).coalesce(1).write.text(f"{odd}/broken")
    coerced = coerce_dates(terms.limit(0))
    empty = with_lineage(coerced, "terminations", "2001-11-06", STAGE_WRITTEN_AT)
    empty.select(*[F.col(f.name).cast(f.dataType) for f in LANDING["terminations"].fields]).coalesce(1).write.parquet(f"{odd}/empty")
    for name in ("broken", "empty"):
        move_file(spark, list_files(spark, f"{odd}/{name}")[0], f"{day}/{name}.parquet")
    out = _ingest(spark, base, "terminations")
    h = read_history(spark, f"{out}/history")
    name = F.regexp_extract("file_name", "(broken|empty)[.]parquet$", 1)
    failed = load_failures(h, _later()).select(F.col("file_name").alias("_n"), F.lit(True).alias("listed_as_failure"))
    return (h.join(failed, F.col("file_name") == F.col("_n"), "left")
            .groupBy(name.alias("file"), "status", F.coalesce("listed_as_failure", F.lit(False)).alias("listed_as_failure"))
            .agg(F.sum("row_count").alias("row_count"), F.count_if(F.col("first_error_message").isNotNull()).alias("errors")))


def q_ingest_new_checkpoint(spark, sf_dir):
    """Two landings through two streams (two checkpoints) into one raw table: the rows of both."""
    terms, out = _api_terminations(spark, sf_dir), scratch_path(spark, "raw")
    even = F.pmod(F.xxhash64("termination_id"), F.lit(2)) == 0
    for i, part in enumerate((terms.where(even), terms.where(~even))):
        base = scratch_path(spark, "landing")
        stage(part, "terminations", STAGE_RUN_DATE, base, written_at=STAGE_WRITTEN_AT)
        ingest_stream(spark, base, "terminations", f"{out}/raw", f"{out}/history", f"{out}/checkpoint{i}").awaitTermination()
    return read_raw(spark, f"{out}/raw", "terminations").drop("_loaded_at", "_pipeline_page_num")


def q_coerce_dates(spark, sf_dir):
    """Dates, date-times with and without an offset, and text: what each becomes, and what is lost."""
    ensure_conf(spark)
    o = A.table(spark, sf_dir, "orders")
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 6
    text = (F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("T00:00:00Z"))).when(k == 2, F.concat(day, F.lit(" 09:00:00")))
            .when(k == 3, F.concat(day, F.lit("T23:30:00-05:00"))).when(k == 4, F.lit("31/12/1999")))
    df = o.select("o_orderkey", text.alias("hire_date"))
    return coerce_dates(df.withColumn("lost", lost_dates(df)))


def q_read_report_json(spark, sf_dir):
    """Write terminations as report envelopes (one per page of 500), read the records back."""
    recs = with_page_numbers(_api_terminations(spark, sf_dir), ["termination_id"], out="_page")
    env = (recs.groupBy("_page")
               .agg(F.collect_list(F.struct(*[f.name for f in API_TERMINATION.fields])).alias("data"))
               .select(F.lit("Terminations").alias("report_name"),
                       F.lit("2001-11-05T02:00:00Z").alias("generated_at"),
                       F.lit("attrix").alias("tenant"),
                       F.size("data").cast("bigint").alias("total_records"), "data"))
    path = scratch_path(spark, "reports")
    env.write.mode("overwrite").json(path)
    return read_report_json(spark, path, API_TERMINATION, multiline=False)


def q_nightly_run(spark, sf_dir):
    """Two runs on one day: a full load, then a repeat whose window is empty."""
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    emp, term = api_records(raw_e, "employees"), api_records(raw_t, "terminations")
    base = scratch_path(spark, "nightly")
    for full in (True, False):
        run_ingest(spark, emp, term, f"{base}/landing", f"{base}/runs", run_date=STAGE_RUN_DATE,
                   full_load=full)
    # the files that the log names are those of the landing, each named once
    runs = RN.read_runs(spark, f"{base}/runs")
    named = runs.select("run_id", F.explode(F.from_json("s3_key", "array<string>")).alias("file"))
    there = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(f"{base}/landing").select(bare_path(F.col("path")).alias("f")))
    per = (named.join(there, bare_path(F.col("file")) == F.col("f"), "left").groupBy("run_id")
           .agg(F.count("*").alias("named"), F.count("f").alias("found")))
    unnamed = there.join(named, bare_path(F.col("file")) == F.col("f"), "left_anti").agg(F.count("*").alias("unnamed"))
    unnamed = unnamed.first()["unnamed"]
    return (runs.join(per, "run_id", "left").withColumn("unnamed", F.lit(unnamed))
            .select("run_date", "entity", "status", "records_staged",
                    (F.coalesce("named", F.lit(0)) > 0).alias("has_files"),
                    ((F.coalesce("named", F.lit(0)) == F.coalesce("found", F.lit(0))) & (F.col("unnamed") == 0)).alias("files_match")))


def q_nightly_turnover(spark, sf_dir):
    """End to end: two nightly runs stage report records, file streams load raw,
    the models are built with the marts written as tables, and the mart is read."""
    orders = A.table(spark, sf_dir, "orders")
    first, later = A.employee_snapshots(orders)
    term = api_records(A.raw_terminations(orders, A.table(spark, sf_dir, "lineitem")), "terminations")
    base = scratch_path(spark, "nightly")
    land, runs = f"{base}/landing", f"{base}/runs"
    run_ingest(spark, api_records(first, "employees"), term, land, runs,
               run_date=NIGHT_1, full_load=True)
    run_ingest(spark, api_records(later, "employees"), term, land, runs, run_date=NIGHT_2)
    raw = {}
    for entity in ("employees", "terminations"):
        ingest_stream(spark, land, entity, f"{base}/raw/{entity}", f"{base}/history/{entity}",
                      f"{base}/checkpoint/{entity}").awaitTermination()
        raw[entity] = read_raw(spark, f"{base}/raw/{entity}", entity)
    models = build(raw["employees"], raw["terminations"], A.ORDERS_AS_OF, A.ORDERS_SPINE_START,
                   materialize=written(spark, f"{base}/marts"))
    return models["turnover"]


NIGHT_1, NIGHT_2 = "2001-11-05", "2001-11-06"

# -- nightly runs that touch what changed, counts at any date -------------------------

# run dates of each night's rows, and the day the mart is built for
NIGHTS = [("1900-01-01", "1997-12-31", "1998-01-15"), ("1998-01-01", "2000-06-30", "2000-07-01"),
          ("2000-07-01", "2100-01-01", A.ORDERS_AS_OF)]


def _night(df, first, last):
    return df.where(F.col("_pipeline_run_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def q_latest_merge(spark, sf_dir):
    """Employee snapshots merged into the latest rows in three nights."""
    raw = A.hr_inputs(spark, sf_dir)[0]
    store = Store(spark, scratch_path(spark, "store"))
    for first, last, _ in NIGHTS:
        tx = store.begin()
        tx.merge("employees", _night(raw, first, last), ["employee_id"], ORDER["employees"], buckets=16)
        tx.commit()
        tx.done()
    return store.snapshot().read("employees")


def q_incremental_mart(spark, sf_dir):
    """The mart after three nights of loads and one that corrects, withdraws and moves exits of all years."""
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "store"))
    for first, last, as_of in NIGHTS:
        update_mart(store, _night(raw_e, first, last), _night(raw_t, first, last), as_of, A.ORDERS_SPINE_START, buckets=16)
    update_mart(store, raw_e.limit(0), A.corrected_terminations(raw_t), A.ORDERS_AS_OF, A.ORDERS_SPINE_START)
    return store.snapshot().read("turnover")


# the checks of the latest rows of a store, in the words of the suite
STORE_CHECKS = [
    Q.Check("employees", "employee_id", "unique"), Q.Check("employees", "hire_date", "not_null"),
    Q.Check("employees", "employment_status", "accepted_values", {"values": ["Active"]}, "warn"),
    Q.Check("employees", "worker_type", "unique"), Q.Check("employees", "hire_date", "not_in_future", {"as_of": "1994-06-30"}, "warn"),
    Q.Check("terminations", "termination_id", "unique"), Q.Check("terminations", "termination_date", "not_null"),
    Q.Check("terminations", "employee_id", "relationships", {"to": "employees", "field": "employee_id"}),
    Q.Check("terminations", "termination_date", "not_before_column", {"reference_column": "last_day_of_work"}),
    Q.Check("terminations", "_pipeline_page_num", "is_between", {"min_value": 2, "max_value": 4}),
    Q.Check("terminations", "recorded_by", "rule", {"fails": "recorded_by like '%7'"}),
]


def q_incremental_checks(spark, sf_dir):
    """Three nights of rows and one of corrections, checked after each by what changed; the last night's result."""
    raw_e, raw_t = A.hr_inputs(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "store"))
    nights = [(_night(raw_e, a, b), _night(raw_t, a, b)) for a, b, _ in NIGHTS] + [(raw_e.limit(0), A.corrected_terminations(raw_t))]
    for emps, terms in nights:
        tx = store.begin()
        tx.merge("employees", emps, ["employee_id"], ORDER["employees"], buckets=16)
        tx.merge("terminations", terms, ["termination_id"], ORDER["terminations"], buckets=16)
        tx.commit()
        tx.done()
        result = update_checks(store, STORE_CHECKS, "1994-06-30", buckets=16)
    return result


def q_asof_headcount(spark, sf_dir):
    """Orders, read as lifecycles, active on every day that has events and on the ship dates of all sixth lines."""
    ensure_conf(spark)
    days = A.table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("as_of_date"))
    dates = A.table(spark, sf_dir, "lineitem").where("l_linenumber = 6").select(F.col("l_shipdate").cast("date").alias("as_of_date"))
    return asof_headcount(A.order_lifecycles(A.table(spark, sf_dir, "orders")), days.unionByName(dates))


def q_lookup_written(spark, sf_dir):
    """Employees looked up in the written dimension by key: one per priority's first order, and one who is not there."""
    dim = lookup_ready(spark, scratch_path(spark, "models"), {"dim_employees": "employee_key"})("dim_employees", _hr(spark, sf_dir)[2])
    wanted = A.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("k"))
    ids = [f"E{r['k']}" for r in wanted.collect()] + ["E-0"]
    found = [FL.lookup(dim, "employee_id", i, hashed_key="employee_key") for i in ids]
    return functools.reduce(DataFrame.unionByName, found)


def q_clustered_raw(spark, sf_dir):
    """Raw terminations written in Z-order of date and type, then filtered by the second column alone."""
    raw = A.hr_inputs(spark, sf_dir)[1]
    path = scratch_path(spark, "clustered")
    cluster_for_write(raw, RAW_CLUSTER["terminations"]).write.parquet(path)
    return spark.read.schema(raw.schema).parquet(path).where("termination_type = 'Involuntary'")


def q_window_problems(spark, sf_dir):
    """What is wrong with windows from an order's day to its total price's day, with the order's status and priority."""
    ensure_conf(spark)
    o = A.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    status = F.when(F.col("o_orderstatus") == "F", "Terminated").when(F.col("o_orderstatus") == "O", "Active").otherwise("Paused")
    windows = o.select("o_orderkey", day.alias("start"), F.date_add(day, (F.floor(F.col("o_totalprice")) % 500 - 100).cast("int")).alias("end"),
                       status.alias("status"), F.when(F.col("o_orderkey") % 2 == 0, "Voluntary").otherwise(F.col("o_orderpriority")).alias("termination_type"))
    return FL.window_problems(windows, "1998-06-30").select("o_orderkey", F.array_join("problems", "; ").alias("problems"))


def q_load_times(spark, sf_dir):
    """Rows per entity whose load time lies within the ingest run that loaded them, and outside it."""
    parts = []
    for entity, landing in (("terminations", _staged(spark, sf_dir)), ("employees", _staged_employees(spark, sf_dir))):
        begun = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        raw = read_raw(spark, f"{_ingest(spark, landing, entity)}/raw", entity)
        ended = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        inside = F.col("_loaded_at").between(as_timestamp(begun), as_timestamp(ended))
        parts.append(raw.agg(F.count_if(inside).alias("inside"), F.count_if(~inside | F.col("_loaded_at").isNull()).alias("outside"))
                     .select(F.lit(entity).alias("entity"), "inside", "outside"))
    return parts[0].unionByName(parts[1])


def q_ingest_continuous(spark, sf_dir):
    """A stream that polls: stopped in the middle of a batch, files arrive late, started again; the latest rows.

    Files and batches hold more rows the more there are, so a larger table means larger ones, not more of them.
    """
    terms, base, out = _api_terminations(spark, sf_dir), scratch_path(spark, "landing"), scratch_path(spark, "raw")
    part = F.pmod(F.xxhash64("termination_id"), F.lit(4))
    per_file = max(2000, terms.count() // 64)
    landed = stage(terms.where(part <= 1), "terminations", STAGE_RUN_DATE, base, written_at=STAGE_WRITTEN_AT, records_per_file=per_file)
    per_batch = max(3, len(landed["files"]) // 4)

    def start():
        return ingest_stream(spark, base, "terminations", f"{out}/raw", f"{out}/history", f"{out}/checkpoint",
                             available_now=False, processing_time="0 seconds", max_files_per_trigger=per_batch)
    first = start()
    while first.isActive and not path_exists(spark, f"{out}/checkpoint/offsets/0"):
        time.sleep(0.02)           # a batch has begun: stop in it
    first.stop()
    # the next night's files, with the days that a lookback reads again
    stage(terms.where(part >= 1), "terminations", NIGHT_2, base, written_at=STAGE_WRITTEN_AT, records_per_file=per_file)
    second = start()
    second.processAllAvailable()
    stage(terms.where(part == 3), "terminations", NIGHT_2, base, written_at=STAGE_WRITTEN_AT)     # arrives while it runs
    second.processAllAvailable()
    second.stop()
    raw = read_raw(spark, f"{out}/raw", "terminations")
    api = [f.name for f in API_TERMINATION.fields]
    return latest_per_key(raw.select(*api), ["termination_id"], [F.col("recorded_at").desc_nulls_first()])


def q_compacted_runs(spark, sf_dir):
    """The events as a log of many files, gathered while records are added: per entity and status, runs and last date."""
    runs, path = _runs(spark, sf_dir), f"{scratch_path(spark, 'runs')}"
    slices = F.pmod(F.xxhash64("run_id"), F.lit(3))
    for i in range(3):
        runs.where(slices == i).repartition(8).write.mode("append").parquet(path)
        RN.compact_runs(spark, path)
    return RN.read_runs(spark, path).groupBy("entity", "status").agg(
        F.count("*").alias("runs"), F.sum("records_staged").alias("records"), F.max("run_date").alias("last_run_date"))


QUERIES: dict[str, Query] = {
    "stage_employees": q_stage_employees,
    "stage_terminations": q_stage_terminations,
    "dim_employees": q_dim_employees,
    "fct_terminations": q_fct_terminations,
    "lifecycle": q_lifecycle,
    "monthly_headcount": q_monthly_headcount,
    "monthly_exits": q_monthly_exits,
    "headcount_orders": q_headcount_orders,
    "monthly_combined": q_monthly_combined,
    "rolling_turnover": q_rolling_turnover,
    "latest_per_key": q_latest_per_key,
    "month_spine": q_month_spine,
    "active_on": q_active_on,
    "page_deep": q_page_deep,
    "dashboard_turnover": q_dashboard_turnover,
    "resolve_window_override": q_resolve_window_override,
    "resolve_window_full": q_resolve_window_full,
    "resolve_window_first_run": q_resolve_window_first_run,
    "load_failures": q_load_failures,
    "ingest_new_checkpoint": q_ingest_new_checkpoint,
    "coerce_dates": q_coerce_dates,
    "filter_terminations": q_filter_terminations,
    "filter_status": q_filter_status,
    "page": q_page,
    "lookup": q_lookup,
    "exits_drill": q_exits_drill,
    "last_success": q_last_success,
    "last_loaded_date": q_last_loaded_date,
    "run_history": q_run_history,
    "failed_runs": q_failed_runs,
    "daily_volume": q_daily_volume,
    "resolve_window": q_resolve_window,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_not_in_future": q_dq_not_in_future,
    "dq_not_before_column": q_dq_not_before_column,
    "dq_is_between": q_dq_is_between,
    "dq_ran_recently": q_dq_ran_recently,
    "dq_freshness": q_dq_freshness,
    "dq_terminated_without_exit": q_dq_terminated_without_exit,
    "dq_spine_contiguous": q_dq_spine_contiguous,
    "dq_suite": q_dq_suite,
    "stage_parquet": q_stage_parquet,
    "ingest_stream": q_ingest_stream,
    "load_history": q_load_history,
    "ingest_employees": q_ingest_employees,
    "recent_loads": q_recent_loads,
    "read_report_json": q_read_report_json,
    "nightly_run": q_nightly_run,
    "nightly_turnover": q_nightly_turnover,
    "latest_merge": q_latest_merge,
    "incremental_mart": q_incremental_mart,
    "asof_headcount": q_asof_headcount,
    "incremental_checks": q_incremental_checks,
    "lookup_written": q_lookup_written,
    "clustered_raw": q_clustered_raw,
    "window_problems": q_window_problems,
    "load_times": q_load_times,
    "ingest_continuous": q_ingest_continuous,
    "compacted_runs": q_compacted_runs,
}
