"""What the pipeline's stages hold at a time, in the executors' JVM (Arrow batches) and in Python (arrays of a slice)."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F


@pytest.mark.parametrize("stage", ["quality_rules", "near_dedup", "benchmark_decontamination"])
def test_stages_send_small_batches_to_python(spark, tmp_path, stage):
    import corpus_pipeline as cp

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    schema = "doc_id long, text string, source string, lang string, n_chars int"
    spark.createDataFrame([(1, "a b c", "s", "en", 5)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i", "some words")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        dict(cp.STAGES)[stage](spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()
        texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
        got = texts.mapInArrow(sizes, "n long, size long").collect()
    finally:
        spark.conf.set(key, before)
    assert sum(r["n"] for r in got) == 6000
    assert max(r["size"] for r in got) < 4 << 20


def _batch():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(vocabulary, k=500)) for _ in range(1400)]      # 4 MB
    return pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])


@pytest.mark.parametrize("work", ["signatures", "sets", "fingerprints"])
def test_python_holds_arrays_of_a_small_slice(work):
    from attrix.llm import decontaminate, near_duplicates

    run = {"signatures": near_duplicates._signed(5, 128, 4), "sets": near_duplicates._sets(5),
           "fingerprints": decontaminate._doc_prints([13])}[work]
    batch = _batch()
    for _ in run([batch.slice(0, 200)]):   # tables that grow with the first slices
        pass
    tracemalloc.start()
    try:
        for _ in run([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
