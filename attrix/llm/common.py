"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from attrix.session import ensure_conf, scratch_path


def ship(spark: SparkSession) -> None:
    """Give this package's modules to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_attrix_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(prefix="attrix-py-"), "attrix_package.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(to)
    sc._attrix_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_conf(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder.

    It cuts the lineage in a way that survives lost executors, is computed once
    however often it is read, and tells the planner its size: a join broadcasts
    it only while its files are below ``autoBroadcastJoinThreshold`` and shuffles
    beyond that.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def document_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells documents apart: the id and a 128-bit hash of the text, never null and in the ids' order.

    Ids may be null or repeat with other texts; rows equal in both are one document.
    """
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t1"), F.xxhash64(F.lit("t"), text_col).alias("t2"))
