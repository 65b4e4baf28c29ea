"""How the filters of a chain interact: every order of five filters, audited in one pass.

A document's outcome at every step of every order depends only on its mask, the set of
filters that it fails.  A mask maps to one wide integer with a 64-bit field for each of
the 120 * 5 steps and each counter; adding two integers adds all their fields at once.
Counts of documents fit 63 bits, so no field overflows into the next.  Spark counts the
documents of each (part, mask) first, which leaves at most 32 rows a part; each row adds
its mask's integer as often as it has documents, and the fields are unpacked once a part.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from attrix.llm.common import stored

# Fixed values of the audit: the filters' letters, in mask bit order, and their limits.
LETTERS = "ABCDE"
MIN_WORDS = 200           # A: fewer words
MIN_DISTINCT_PERCENT = 50  # B: a smaller share of distinct words
MAX_UPPER_PERCENT = 3     # C: a larger share of capitals A-Z
SYMBOLS = b"#$%&*|"       # D: any of these

ORDERS = ["".join(p) for p in permutations(LETTERS)]
STEPS = len(LETTERS)
COUNTERS = ("kept", "removed", "redundant", "unique_fails")
FIELD_BYTES = 8

_UPPER = bytes(range(0x41, 0x5B))


def text_mask(data: bytes) -> int:
    """Bits A to D of a text's mask (UTF-8 bytes); see the constants above."""
    words = data.split()      # bytes.split cuts at 0x20 and 0x09-0x0D
    n = len(words)
    mask = n < MIN_WORDS
    mask |= (100 * len(set(words)) < MIN_DISTINCT_PERCENT * n) << 1
    upper = len(data) - len(data.translate(None, _UPPER))
    points = len(data) if data.isascii() else len(data.decode("utf-8", "surrogatepass"))
    mask |= (100 * upper > MAX_UPPER_PERCENT * points) << 2
    mask |= (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    return int(mask)


def _judge(batches):
    for b in batches:
        texts = b.column(2).cast(pa.large_binary())
        masks, keys = [], []
        for t in texts:
            data = t.as_py() or b""
            masks.append(text_mask(data))
            keys.append(hashlib.blake2b(data, digest_size=16).digest())
        yield pa.record_batch([b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(keys, pa.binary())],
                              names=["doc_id", "part", "mask", "same"])


@lru_cache(maxsize=1)
def wide_counters() -> list[int]:
    """The wide integer of each mask: field (order, step, counter) is 1 where it counts the document."""
    out = []
    for mask in range(1 << STEPS):
        fields = np.zeros((len(ORDERS), STEPS, len(COUNTERS)), "<u8")
        for o, order in enumerate(ORDERS):
            gone = False
            for s, letter in enumerate(order):
                bit = 1 << LETTERS.index(letter)
                fails = bool(mask & bit)
                fields[o, s] = (not gone and not fails, not gone and fails, gone and fails, mask == bit)
                gone |= fails
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return out


def unpack(total: int) -> np.ndarray:
    """(order, step, counter) counts of a sum of wide integers."""
    shape = (len(ORDERS), STEPS, len(COUNTERS))
    return np.frombuffer(total.to_bytes(FIELD_BYTES * shape[0] * shape[1] * shape[2], "little"), "<i8").reshape(shape)


def _unpack_parts(batches):
    letters = np.array([[LETTERS.index(c) for c in o] for o in ORDERS])
    wide = wide_counters()
    for b in batches:
        for part, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            every, good, toxic = (unpack(sum(r[k] * wide[r["mask"]] for r in rows)) for k in ("n", "good", "toxic"))
            shapley = np.array([every[..., 1][letters == i].sum() for i in range(STEPS)])[letters]
            size = letters.size
            yield pa.record_batch(
                [pa.array([part] * size), pa.array(np.repeat(ORDERS, STEPS)), pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))),
                 *[pa.array(every[..., i].ravel()) for i in range(len(COUNTERS))],
                 pa.array(good[..., 1].ravel()), pa.array(toxic[..., 1].ravel()), pa.array(shapley.ravel().astype(np.int64))],
                names=["part", "filter_order", "step", *COUNTERS, "good_lost", "toxic_lost", "shapley"])


def audit_filters(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, filter order and step with the counts of that step's filter.

    ``kept`` documents remain after the step, ``removed`` go in it, ``redundant`` fail its filter
    but were gone, ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are those removed
    here with label quality 1 or toxic 1; ``shapley`` is the filter's removed, summed over all orders.
    Filter E fails a document whose text also stands under a smaller id anywhere in the table.

    A null text is empty and a null part the empty string.  A row without an id has no smaller and
    no larger one, so it passes E, and no label.  Rows that repeat an id count one by one; equal
    texts under one id do not fail each other.  A label that repeats counts once: any row with 1
    marks the document.  Other columns are ignored.  An empty table has no parts, hence no rows.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.col(text_col).alias("text"))
    ids = dict(own.dtypes)["doc_id"]
    rows = own.mapInArrow(_judge, f"doc_id {ids}, part string, mask int, same binary")
    # rows equal in all four count together, so a hot id, or many rows without one, is summed before it is joined
    rows = stored(rows.groupBy("doc_id", "part", "mask", "same").agg(F.count("*").alias("n")), "judged")
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg((F.max(F.when(F.col("quality") == 1, 1)) == 1).alias("good"), (F.max(F.when(F.col("toxic") == 1, 1)) == 1).alias("toxic")))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    known = (rows.where("doc_id is not null").join(marks, "doc_id", "left")
             .select("part", "mask", "same", "n", F.struct("doc_id", "n").alias("at"), flag("good"), flag("toxic")))
    unknown = rows.where("doc_id is null").select(
        "part", "mask", "same", "n", F.lit(None).cast(dict(known.dtypes)["at"]).alias("at"),
        F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    # copies of one text: a row per part and label, with its smallest id and how often that stands
    copies = (known.union(unknown).groupBy("same", "mask", "part", "good", "toxic")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("at").isNull(), F.col("n")).otherwise(0)).alias("free"), F.min("at").alias("at"))
              .withColumn("first", F.min("at.doc_id").over(Window.partitionBy("same"))))
    passing = F.col("free") + F.when(F.col("at.doc_id") == F.col("first"), F.col("at.n")).otherwise(0)
    split = copies.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", passing.alias("n")),
        F.struct((F.col("mask") + F.lit(1 << (STEPS - 1))).alias("mask"), (F.col("n") - passing).alias("n")))).alias("m"))
    masks = (split.where("m.n > 0").groupBy("part", F.col("m.mask").alias("mask"))
             .agg(F.sum("m.n").alias("n"), F.sum(F.when(F.col("good"), F.col("m.n")).otherwise(0)).alias("good"),
                  F.sum(F.when(F.col("toxic"), F.col("m.n")).otherwise(0)).alias("toxic")))
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    counts = ", ".join(f"{c} long" for c in (*COUNTERS, "good_lost", "toxic_lost", "shapley"))
    return parts.mapInArrow(_unpack_parts, f"part string, filter_order string, step int, {counts}")
