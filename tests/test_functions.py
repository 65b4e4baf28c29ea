import datetime as dt

from pyspark.sql import functions as F

from attrix.functions import hours_between, surrogate_key, tenure_bucket


def test_tenure_bucket_bounds_and_null(spark):
    days = [89, 90, 364, 365, 729, 730, 1824, 1825, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r.b for r in df.select(tenure_bucket(F.col("d")).alias("b")).collect()]
    assert got == ["1. 0-90 days", "2. 91-365 days", "2. 91-365 days", "3. 1-2 years", "3. 1-2 years",
                   "4. 2-5 years", "4. 2-5 years", "5. 5+ years", "5. 5+ years"]   # null → last bucket
    unk = df.select(tenure_bucket(F.col("d"), F.col("d").isNull()).alias("b")).collect()[-1].b
    assert unk == "Unknown"


def test_surrogate_key_parts_and_nulls(spark):
    row = spark.range(1).select(
        surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("k2"),
        F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")).alias("expect")).first()
    assert row.k2 == row.expect


def test_hours_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(hours_between("a", "b").alias("h")).first().h == 1


def test_scale_conf_partition_size():
    from attrix.session import scale_conf
    big = scale_conf(100 * 2**40, total_cores=8000)          # 100 TB on 8000 cores
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))   # about 256 MB each
    small = scale_conf(10**9, total_cores=8)                 # 1 GB locally
    assert small["spark.sql.shuffle.partitions"] == "16"
    mid = scale_conf(4 * 2**40, total_cores=8000)            # 4 TB: input / 256 MB
    assert mid["spark.sql.shuffle.partitions"] == str(4 * 2**40 // (256 * 2**20))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
