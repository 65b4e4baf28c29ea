"""Build the model graph: staging → dimension → fact → rolling mart.

Staging models are lazy views; the dimension, fact and mart are materialised
by a ``Materializer`` — a reliable checkpoint or a table written to a shared
folder — so each downstream model (and every quality check) reads a stored
result instead of re-deriving its inputs. Both survive executor loss: the data
lives in the shared folder, not in executor memory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attrix.plans.marts import dim_employees, fct_terminations, turnover_mart
from attrix.plans.staging import stage_employees, stage_terminations
from attrix.schema import ROLLING_MONTHS, SPINE_START
from attrix.session import shared_dir

Materializer = Callable[[str, DataFrame], DataFrame]


def lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def checkpointed(spark: SparkSession) -> Materializer:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (cuts lineage)."""
    shared_dir(spark)
    return lambda name, df: df.checkpoint(eager=True)


def cached(spark: SparkSession) -> Materializer:
    """Columnar cache in executor memory, spilling to disk (``MEMORY_AND_DISK``).

    For short-lived reuse inside one job (a quality suite over the models): no
    file commit, and a lost executor's partitions are recomputed from lineage.
    """
    from pyspark import StorageLevel

    def m(name: str, df: DataFrame) -> DataFrame:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    return m


def written(spark: SparkSession, base: str, fmt: str = "parquet") -> Materializer:
    """Overwrite ``base/<name>`` and read it back: the model becomes a table."""
    def m(name: str, df: DataFrame) -> DataFrame:
        path = f"{base.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        return spark.read.format(fmt).load(path)
    return m


def bucketed(spark: SparkSession, base: str, buckets: int, key: str = "employee_key",
             keyed=("stg_terminations", "dim_employees", "fct_terminations")) -> Materializer:
    """Tables bucketed and sorted on ``key`` for the models joined on it; others as ``written``.

    The dimension, the fact and the staged terminations meet on the employee
    key (fact = terminations ⋈ dimension, lifecycle = dimension ⋈ fact). With
    the same bucket count on both sides those joins read matching buckets
    directly, with no shuffle of either side. Tables go to the session catalog
    with their data under ``base`` (the shared folder).
    """
    import uuid
    plain = written(spark, base)
    run = uuid.uuid4().hex[:8]

    def m(name: str, df: DataFrame) -> DataFrame:
        if name not in keyed:
            return plain(name, df)
        table = f"attrix_{name}_{run}"
        (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
           .option("path", f"{base.rstrip('/')}/{name}").saveAsTable(table))
        return spark.table(table)
    return m


def lookup_ready(spark: SparkSession, base: str, keys: dict[str, str], files: int | None = None) -> Materializer:
    """As ``written``, for point lookups: a model with a key in ``keys`` is sorted by it and has Bloom filters on it.

    The files cover ranges of the key, so an equality on it prunes row groups by their min and
    max, and, where a value lies between those without being there, by the filter: a lookup of
    an absent key reads no row group.
    """
    plain = written(spark, base)

    def m(name: str, df: DataFrame) -> DataFrame:
        key = keys.get(name)
        if key is None:
            return plain(name, df)
        path = f"{base.rstrip('/')}/{name}"
        n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        (df.repartitionByRange(n, key).sortWithinPartitions(key).write.mode("overwrite")
           .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
           .parquet(path))
        return spark.read.schema(df.schema).parquet(path)
    return m


# SQL names under which build(views=True) registers the models
VIEW_NAMES = {"stg_employees": "stg_employees", "stg_terminations": "stg_terminations",
              "dim_employees": "dim_employees", "fct_terminations": "fct_terminations",
              "turnover": "fct_turnover_rolling_12m"}


def build(raw_employees: DataFrame, raw_terminations: DataFrame, as_of,
          spine_start=SPINE_START, months: int = ROLLING_MONTHS,
          materialize: Materializer = lazy, materialize_staging: bool = False,
          group: str = "location_state", dense: bool = False,
          views: bool = False) -> dict[str, DataFrame]:
    """All models keyed by name; ``materialize`` stores the marts (and staging if asked).

    ``views=True`` also registers each model as a temporary view (``VIEW_NAMES``),
    so existing SQL over the models runs unchanged through ``spark.sql``.
    """
    ms = materialize if materialize_staging else lazy
    stg_e_df = stage_employees(raw_employees, as_of)
    stg_t_df = stage_terminations(raw_terminations)
    if ms is lazy:
        stg_e, stg_t = stg_e_df, stg_t_df
    else:
        # the two staging models are independent: materialise them as concurrent jobs
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(2) as pool:
            fe = pool.submit(ms, "stg_employees", stg_e_df)
            ft = pool.submit(ms, "stg_terminations", stg_t_df)
            stg_e, stg_t = fe.result(), ft.result()
    dim = materialize("dim_employees", dim_employees(stg_e))
    fct = materialize("fct_terminations", fct_terminations(stg_t, dim))
    turnover = materialize("turnover", turnover_mart(dim, fct, as_of, spine_start, months, group,
                                                     dense))
    models = {"stg_employees": stg_e, "stg_terminations": stg_t, "dim_employees": dim,
              "fct_terminations": fct, "turnover": turnover}
    if views:
        for name, df in models.items():
            df.createOrReplaceTempView(VIEW_NAMES[name])
    return models
