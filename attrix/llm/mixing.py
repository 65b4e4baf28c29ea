"""Mixing sources to target weights.

Tokens (words) are summed per source, targets share out the corpus by weight
with a bound on repetition, and each document is emitted ``floor(rate)`` times
plus one hash-seeded Bernoulli copy with the fraction as its probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attrix.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on seed and key only: 52 bits of an MD5 digest."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def ranked(keys: DataFrame, column: str, out: str) -> DataFrame:
    """0-based rank of distinct keys in code-point order, null last, without a one-task sort.

    The keys are range-partitioned, written once, and numbered from per-partition counts,
    of which the driver sees one row per partition.
    """
    n = min(200, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))   # of a table of names: one offset each
    order = F.col(column).asc_nulls_last()
    k = (keys.repartitionByRange(n, order).sortWithinPartitions(order)
             .withColumn("_p", F.spark_partition_id())
             .withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    k = stored(k, "ranked")
    counts = {r["_p"]: r["n"] for r in k.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(before)]
        before += counts[p]
    if not offsets:
        return k.withColumn(out, F.lit(0).cast("long")).drop("_p", "_i")
    offset = F.create_map(*offsets)[F.col("_p")]
    return k.withColumn(out, (offset + F.col("_i")).cast("long")).drop("_p", "_i")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Per source (``source``, ``source_size``): its target, at most ``max_repeat`` times its size.

    Sources in code-point order, null last, take the weights in turn.  What a bounded
    source cannot take is shared by weight among the others until none is above its
    bound; each round is one aggregation that returns one row.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    s = stored(ranked(sizes, "source", "_rank").withColumn("weight", w.cast("long")).drop("_rank"), "sources")
    bound = F.col("source_size") * max_repeat
    total = s.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    all_words, rest, weight, free = total["t"] or 0, total["t"] or 0, total["w"] or 1, None
    capped = F.lit(False)
    while True:
        capped = bound * F.lit(weight) <= F.col("weight") * F.lit(rest)
        r = s.agg(F.sum(F.when(capped, bound)).alias("b"), F.sum(F.when(~capped, F.col("weight"))).alias("w"),
                  F.count(F.when(~capped, 1)).alias("n")).first()
        if r["n"] == free or not r["n"]:
            break
        rest, weight, free = all_words - (r["b"] or 0), r["w"], r["n"]
    target = F.when(capped, bound.cast("double")).otherwise(
        (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(weight)))
    return stored(s.select("source", "source_size", target.alias("target")), "targets")


def mix_rates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: str = SEED) -> DataFrame:
    """Per row: id, size, source_size, target, rate, copies and taken = copies * size.

    Null text has size 0; a null source is a source like any other; a source without
    words has target 0 and is not copied.  Rows of equal id draw the same number, so
    repeated rows are copied alike.  Other columns are ignored.  An empty table gives
    an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                      word_count(F.col(text_col)).alias("size"))
    return _rates(own, own, weights, max_repeat, seed).select(
        "doc_id", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def _rates(sized: DataFrame, rows: DataFrame, weights, max_repeat, seed) -> DataFrame:
    per = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    per = per.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor("rate")
    extra = unit_hash(F.col("doc_id"), seed) < F.col("rate") - whole
    return (rows.join(per, rows["source"].eqNullSafe(per["_source"]), "left").drop("_source")
                .withColumn("rate", rate)
                .withColumn("copies", whole + extra.cast("long")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: str = SEED,
        copy_col: str = "copy") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its rate says, numbered from 1 in ``copy_col``.

    ``docs`` has doc_id, text and source; all its columns are kept (an own column named
    ``copy_col`` is replaced).
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         "doc_id", "source", word_count(F.col("text")).alias("size"))
    out = _rates(packed.select("source", "size"), packed.select("_row", "doc_id", "source"),
                 weights, max_repeat, seed)
    keep = [F.col("_row").getField(c).alias(c) for c in docs.columns if c != copy_col]
    return (out.where(F.col("copies") > 0)
               .select(*keep, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias(copy_col)))
