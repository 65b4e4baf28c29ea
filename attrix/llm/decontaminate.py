"""Benchmark decontamination by winnowing.

A window is ``length`` consecutive words of a benchmark item (an item of fewer words
is one window).  Of every window the smallest hash of about half as many words is kept
as a fingerprint; a document that holds the window holds the fingerprint at the same
place in it, so the join of fingerprints misses no shared span of a window or more.
Hits are extended to the windows around them, which are compared by a 128-bit hash.

The fingerprints and windows of the benchmark are written as tables first: the joins
broadcast them while their files are below ``autoBroadcastJoinThreshold`` and are
shuffle joins, split where a fingerprint is hot, beyond it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import document_key, stored
from attrix.llm.words import ALNUM_WORD, anchors, find_words, mix, run_hashes, signed, slices

LENGTH = 13
SLICE = 1 << 19   # bytes of texts worked on at a time


def _seed(n: int) -> int:
    return (n + 1) // 2


def _marks(g: np.ndarray, n: int) -> np.ndarray:
    return signed(mix(g + np.uint64(n)))


def _item_lengths(w, length: int) -> np.ndarray:
    """The window length of each item: ``length``, or the number of its words if smaller."""
    return np.minimum(w.n_words, length)


def _item_starts(w, n: np.ndarray):
    """Start and length of every window of every item."""
    count = np.where(n > 0, w.n_words - n + 1, 0)
    before = np.concatenate(([0], np.cumsum(count)))[:-1]
    item = np.repeat(np.arange(len(n)), count)
    return np.arange(count.sum()) - before[item] + w.first[:-1][item], n[item], item


def _item_prints(length: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(0), SLICE):
                w = find_words(data, off, ALNUM_WORD, fold=True)
                n = _item_lengths(w, length)
                for k in np.unique(n[n > 0]):
                    mine = n[w.doc] == k
                    whole = mine & (w.first[w.doc + 1] - np.arange(len(w.doc)) >= k)
                    _, _, g, _, _ = anchors(w.hash, w.first, w.doc, whole, int(k), _seed(int(k)))
                    yield pa.record_batch([pa.array(_marks(g, int(k))), pa.array(np.full(len(g), k, np.int32))],
                                          names=["h", "n"])
    return run


def _item_windows(length: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), SLICE):
                w = find_words(data, off, ALNUM_WORD, fold=True)
                at, n, item = _item_starts(w, _item_lengths(w, length))
                yield pa.record_batch([b.column(0).take(pa.array(item + lo)), pa.array(n.astype(np.int32)),
                                       pa.array(signed(run_hashes(w.hash, at, n))),
                                       pa.array(signed(run_hashes(w.hash, at, n, 2)))],
                                      names=["item_id", "n", "r1", "r2"])
    return run


def _doc_anchors(w, lengths):
    for n in lengths:
        whole = w.first[w.doc + 1] - np.arange(len(w.doc)) >= n
        yield n, anchors(w.hash, w.first, w.doc, whole, n, _seed(n))


def _doc_prints(lengths: list[int]):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), SLICE):
                w = find_words(data, off, ALNUM_WORD, fold=True)
                for n, (at, doc, g, _, _) in _doc_anchors(w, lengths):
                    yield pa.record_batch([b.column(0).take(pa.array(doc + lo)), pa.array(_marks(g, n)),
                                           pa.array((at - w.first[doc]) * 64 + n)], names=["doc_id", "h", "mark"])
    return run


def _doc_windows(lengths: list[int]):
    """Windows around the marked anchors (third column: sets of 64 * position + window length)."""
    def run(batches):
        for b in batches:
            marks = b.column(2)
            moff, mval = marks.offsets.to_numpy().astype(np.int64), marks.values.to_numpy()
            for lo, hi, data, off in slices(b.column(1), SLICE):
                w = find_words(data, off, ALNUM_WORD, fold=True)
                mine = mval[moff[lo]:moff[hi]]
                base = np.repeat(w.first[:-1], np.diff(moff[lo:hi + 1]))
                for n, (at, doc, _, low, high) in _doc_anchors(w, lengths):
                    pick = mine % 64 == n
                    i = np.searchsorted(at, np.sort(base[pick] + mine[pick] // 64))
                    count = high[i] - low[i] + 1
                    s = np.repeat(low[i] - np.concatenate(([0], np.cumsum(count)))[:-1], count) + np.arange(count.sum())
                    d = np.repeat(doc[i], count)
                    yield pa.record_batch(
                        [b.column(0).take(pa.array(d + lo)), pa.array((s - w.first[d])), pa.array(np.full(len(s), n, np.int32)),
                         pa.array(signed(run_hashes(w.hash, s, n))), pa.array(signed(run_hashes(w.hash, s, n, 2)))],
                        names=["doc_id", "start", "n", "r1", "r2"])
    return run


def _count_words(batches):
    for b in batches:
        n = [find_words(data, off, ALNUM_WORD, hashes=False).n_words for _, _, data, off in slices(b.column(1), SLICE)]
        yield pa.record_batch([b.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *n]))], names=["doc_id", "n_words"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, percent: int = 5,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: n_words, n_hit, n_items, items (sorted as strings) and contaminated.

    A word is hit if it lies in an occurrence of a benchmark window; a document is
    contaminated if it has a hit and ``100 * n_hit >= percent * n_words``.  Null and empty
    texts have no words; an empty benchmark hits nothing; an item with a null id hits but is
    not listed.  Every row is judged by its own text, whatever its id is, null or repeated.
    Columns other than those named are ignored.
    """
    found = _contamination(docs, benchmark, length, percent, id_col, text_col, item_col, item_text_col)
    return found.withColumn("doc_id", F.col("doc_id.id"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, percent: int = 5,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``find_contamination`` does not call contaminated, with all their columns."""
    found = _contamination(docs, benchmark, length, percent, id_col, text_col, "item_id", "text")
    gone = stored(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"), document_key(id_col, text_col).alias("doc_id"))
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def _contamination(docs, benchmark, length, percent, id_col, text_col, item_col, item_text_col) -> DataFrame:
    """As ``find_contamination``, with the ``document_key`` as doc_id."""
    item_ids = dict(benchmark.dtypes)[item_col]
    own = docs.select(document_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids = dict(own.dtypes)["doc_id"]
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    prints = stored(items.select("text").mapInArrow(_item_prints(length), "h long, n int").distinct(), "prints")
    windows = stored(items.mapInArrow(_item_windows(length), f"item_id {item_ids}, n int, r1 long, r2 long")
                     .groupBy("n", "r1", "r2").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")), "windows")
    lengths = sorted(r["n"] for r in prints.select("n").distinct().collect())  # at most ``length`` of them

    marks = (own.mapInArrow(_doc_prints(lengths), f"doc_id {ids}, h long, mark long")
             .join(prints.select("h"), "h", "left_semi")
             .groupBy("doc_id").agg(F.collect_set("mark").alias("marks")))
    spots = (own.join(marks.withColumnRenamed("doc_id", "_d"), F.col("doc_id").eqNullSafe(F.col("_d")))
             .select("doc_id", "text", "marks")
             .mapInArrow(_doc_windows(lengths), f"doc_id {ids}, start long, n int, r1 long, r2 long"))
    hits = (spots.join(windows, ["n", "r1", "r2"])
            .groupBy("doc_id")
            .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
                              F.greatest(a["end"], s["end"]).alias("end")), lambda a: a["n"])
    hits = hits.select(F.col("doc_id").alias("_d"), covered.alias("n_hit"), "items")
    return (own.mapInArrow(_count_words, f"doc_id {ids}, n_words long")
            .join(hits, F.col("doc_id").eqNullSafe(F.col("_d")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))))
