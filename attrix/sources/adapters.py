"""Adapters that give the driver's generic tables the HR shapes.

They let every operator run, at any scale, on data Spark derives from the
given tables (``orders``, ``lineitem``, ``events``):

* raw employees — each order is an employee. Two nightly snapshots: the first
  (run the day after the order date) shows everyone active; a later one (run
  on ``as_of``) re-lists the finished ('F') orders as terminated. Dedup keeps
  the later snapshot where both exist.
* raw terminations — each line of a finished order is one load of that
  order's termination record (same termination id); dedup keeps the latest
  load, so the exit date is the last ship date. Pairs of identical
  (order, line) keys exist in the data and exercise the tie-breaks.
* runs — each event is a run log entry; 'error' events are FAILED runs of
  entity ``pipeline``; purchases/signups are ``terminations``/``employees`` runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from attrix.functions.dates import as_date
from attrix.session import ensure_conf

# Fixed adapter parameters (query constants; the driver data spans 1995–2001
# for orders and January 2024 for events).
ORDERS_AS_OF = "2001-12-31"
ORDERS_SPINE_START = "1995-01-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The tables are immutable, so each file's schema is inferred once per
    process (later reads skip the footer-reading job)."""
    ensure_conf(spark)       # UTC session time: instants and wall-clock values agree
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)



def _ts_of_date(d, hours: int):
    return F.timestamp_add("HOUR", F.lit(hours), d.cast("timestamp_ntz"))


def _employee_attrs(o: DataFrame) -> list:
    pr = F.col("o_orderpriority")
    return [
        F.concat(F.lit("E"), F.col("o_orderkey")).alias("employee_id"),
        F.concat(F.lit(" Cust"), F.col("o_custkey")).alias("first_name"),
        F.concat(F.lit("Order"), F.col("o_orderkey"), F.lit(" ")).alias("last_name"),
        F.concat(F.lit("E"), F.col("o_orderkey"), F.lit("@Corp.Example ")).alias("email"),
        F.concat(F.lit("Grade "), F.substring(pr, 1, 1)).alias("job_title"),
        F.expr("substring(o_orderpriority, 3)").alias("department"),
        F.lower(pr).alias("location_city"),
        F.concat(F.lit(" "), F.lower(pr)).alias("location_state"),
        F.lit("us").alias("location_country"),
        F.date_sub(F.col("o_orderdate").cast("date"),
                   F.floor(F.col("o_totalprice") / 100).cast("int")).alias("hire_date"),
    ]


def raw_employees(orders: DataFrame, as_of: str = ORDERS_AS_OF) -> DataFrame:
    first, later = employee_snapshots(orders, as_of)
    return first.unionByName(later)


def employee_snapshots(orders: DataFrame, as_of: str = ORDERS_AS_OF):
    """(first snapshot: everyone active, later snapshot: finished orders terminated)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      "o_orderdate", "o_orderpriority")

    def snapshot(src: DataFrame, status, run_date) -> DataFrame:
        written = _ts_of_date(run_date, 2)
        return src.select(
            *_employee_attrs(src),
            status.alias("employment_status"),
            F.when(F.col("o_orderstatus") == "P", F.lit("contractor"))
             .otherwise(F.lit("Employee")).alias("worker_type"),
            F.concat(F.lit("E"), F.col("o_custkey")).alias("manager_id"),
            F.lit("employees").alias("_pipeline_entity"),
            run_date.alias("_pipeline_run_date"),
            F.floor(F.col("o_orderkey") / 500).alias("_pipeline_page_num"),
            written.alias("_pipeline_written_at"),
            F.timestamp_add("HOUR", F.lit(1), written).alias("_loaded_at"),
        )

    first = snapshot(o, F.lit("Active"), F.date_add(F.col("o_orderdate").cast("date"), 1))
    later = snapshot(o.where(F.col("o_orderstatus") == "F"), F.lit("Terminated"), as_date(as_of))
    return first, later


def raw_terminations(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    finished = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    li = lineitem.join(finished, lineitem["l_orderkey"] == finished["o_orderkey"], "left_semi")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    tdate = F.col("l_shipdate").cast("date")
    written = F.timestamp_add("MINUTE", F.col("l_linenumber"),
                              F.timestamp_add("DAY", F.lit(1), F.col("l_shipdate")))
    return li.select(
        F.concat(F.lit("T"), F.col("l_orderkey")).alias("termination_id"),
        F.concat(F.lit("E"), F.col("l_orderkey")).alias("employee_id"),
        tdate.alias("termination_date"),
        F.date_sub(tdate, F.floor(F.col("l_discount") * 100).cast("int")).alias("last_day_of_work"),
        F.when(flag == "R", F.lit(" voluntary")).when(flag == "A", F.lit("Involuntary"))
         .otherwise(F.lit("INVOLUNTARY ")).alias("termination_type"),
        F.when((flag == "R") & (status == "F"), F.lit("Resignation"))
         .when(flag == "R", F.lit("Retirement"))
         .when(flag == "A", F.lit("Layoff"))
         .when(status == "F", F.lit("Performance"))
         .otherwise(F.lit("Termination for Cause")).alias("termination_reason"),
        F.concat(F.lit(" line "), F.col("l_linenumber"), F.lit(" ")).alias("termination_reason_detail"),
        (status == "O").alias("rehire_eligible"),
        F.concat(F.lit(" hr"), F.col("l_suppkey")).alias("recorded_by"),
        F.timestamp_add("HOUR", F.lit(9), F.col("l_shipdate")).alias("recorded_at"),
        F.lit("terminations").alias("_pipeline_entity"),
        F.date_add(tdate, 1).alias("_pipeline_run_date"),
        F.col("l_linenumber").cast("bigint").alias("_pipeline_page_num"),
        written.alias("_pipeline_written_at"),
        F.timestamp_add("HOUR", F.lit(1), written).alias("_loaded_at"),
    )


def corrected_terminations(terminations: DataFrame) -> DataFrame:
    """A last load of some termination records, by order number modulo 40: a later date (0), withdrawn (1), another employee (2)."""
    number = F.substring("termination_id", 2, 20).cast("bigint")
    kind = number % 40
    written = F.lit("2001-12-30 02:00:00").cast("timestamp_ntz")
    changed = {"termination_date": F.when(kind == 0, F.date_add("termination_date", 45)).when(kind == 2, F.col("termination_date")),
               "employee_id": F.when(kind == 2, F.concat(F.lit("E"), number + 1)).otherwise(F.col("employee_id")),
               "_pipeline_run_date": F.lit("2001-12-30").cast("date"), "_pipeline_written_at": written, "_loaded_at": written}
    return terminations.where((kind <= 2) & (F.col("_pipeline_page_num") == 1)).select(
        *[changed.get(c, F.col(c)).alias(c) for c in terminations.columns])


def runs_from_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    secs = F.floor(F.col("value"))
    return events.select(
        F.concat(F.lit("R"), F.col("event_id")).alias("run_id"),
        F.col("ts").cast("date").alias("run_date"),
        F.when(et == "error", F.lit("pipeline")).when(et == "purchase", F.lit("terminations"))
         .when(et == "signup", F.lit("employees")).otherwise(et).alias("entity"),
        secs.cast("bigint").alias("records_staged"),
        F.when(et != "error", F.col("props")).alias("s3_key"),
        F.when(et == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("SECOND", secs.cast("int"), F.col("ts")).alias("completed_at"),
        F.when(et == "error", F.concat(F.lit("error for user "), F.col("user_id")))
         .alias("error_message"),
    )


def hr_inputs(spark: SparkSession, sf_dir: str):
    """(raw_employees, raw_terminations) derived from the driver tables."""
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    return raw_employees(orders), raw_terminations(orders, lineitem)


def order_lifecycles(orders: DataFrame) -> DataFrame:
    """Orders read directly as lifecycles (no staging): start = order date, finished
    orders end a price-derived number of days later; state = order priority."""
    start = F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_orderkey").alias("employee_key"),
        F.col("o_orderpriority").alias("location_state"),
        start.alias("hire_date"),
        F.when(F.col("o_orderstatus") == "F",
               F.date_add(start, F.floor(F.col("o_totalprice") / 1000).cast("int")))
         .alias("termination_date"))
