"""Substring de-duplication by seed and extend.

Every run of ``length`` words holds a winnowed anchor (the smallest hash of
``SEED_WORDS`` words in the run, which equal runs share).  Anchors that occur once
are dropped by a join with the repeated anchor hashes.  The others are extended by
up to ``length - SEED_WORDS`` words both ways: occurrences with one extended context
form a class, of which the earliest stands for all - every run around the others
starts earlier there.  Only the representatives of anchors with several contexts
compare their runs one by one.  The repeated runs of a document merge into maximal
spans, whose words go.

No pair of occurrences is ever emitted, so a passage that a third of the corpus
shares costs one row per occurrence, which is counted before it is shuffled and
split by the skew join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import document_key, stored
from attrix.llm.words import (SPACE_WORD, anchors, byte_slices, find_words, mix, run_hashes, signed, slices,
                              whole_grams)

SEED_WORDS = 8
LENGTH = 20


def _seeds(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for lo, hi, data, off in slices(b.column(1)):
                w = find_words(data, off, SPACE_WORD)
                at, doc, g, _, _ = anchors(w.hash, w.first, w.doc, whole_grams(w, length), length, seed)
                yield pa.record_batch([pa.array(signed(g)), ids.slice(lo, hi - lo).take(pa.array(doc)),
                                       pa.array((at - w.first[doc]).astype(np.int32))], names=["h", "doc_id", "pos"])
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames: what is shuffled and read again is less than half as large."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        texts = [z.compress(t.as_buffer()) if t.is_valid else None for t in b.column(1)]
        yield pa.record_batch([b.column(0), pa.array(texts, pa.binary())], names=["doc_id", "z"])


def _unpacked(col: pa.Array) -> list[bytes]:
    d = zstandard.ZstdDecompressor()
    return [d.decompress(z.as_py()) if z.is_valid else b"" for z in col]


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column; a null is an empty list."""
    col = col.fill_null([]) if col.null_count else col
    off = col.offsets.to_numpy().astype(np.int64)
    return col.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False), off - off[0]


def _marked(b: pa.RecordBatch, length: int, seed: int):
    """Per slice of packed texts: first row, words, and the anchors named in the third column."""
    pos, off = _lists(b.column(2))
    for lo, hi, data, offsets in byte_slices(_unpacked(b.column(1))):
        w = find_words(data, offsets, SPACE_WORD)
        at, doc, g, low, high = anchors(w.hash, w.first, w.doc, whole_grams(w, length), length, seed)
        named = np.repeat(w.first[:-1], np.diff(off[lo:hi + 1])) + pos[off[lo]:off[hi]]
        i = np.searchsorted(at, np.sort(named))
        yield lo, w, at[i], doc[i], g[i], low[i], high[i]


def _contexts(length: int, seed: int):
    def run(batches):
        for b in batches:
            for lo, w, at, doc, g, _, _ in _marked(b, length, seed):
                left = np.maximum(w.first[doc], at - (length - seed))
                right = np.minimum(w.first[doc + 1], at + length)
                ctx = run_hashes(w.hash, left, right - left, 1) ^ mix((at - left).astype(np.uint64))
                yield pa.record_batch(
                    [pa.array(signed(g)), pa.array(signed(ctx)), b.column(0).take(pa.array(doc + lo)),
                     pa.array((at - w.first[doc]).astype(np.int32))], names=["h", "ctx", "doc_id", "pos"])
    return run


def _runs(length: int, seed: int):
    def run(batches):
        for b in batches:
            for lo, w, at, doc, _, low, high in _marked(b, length, seed):
                n = high - low + 1
                s = np.repeat(low - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(n.sum())
                doc = np.repeat(doc, n)
                yield pa.record_batch(
                    [pa.array(signed(run_hashes(w.hash, s, length))), pa.array(signed(run_hashes(w.hash, s, length, 2))),
                     b.column(0).take(pa.array(doc + lo)), pa.array((s - w.first[doc]).astype(np.int32))],
                    names=["r1", "r2", "doc_id", "start"])
    return run


def _kept(length: int, seed: int, texts: bool):
    """Columns: doc_id, z, anchors that repeat and stand for no context, starts of later runs."""
    def run(batches):
        for b in batches:
            data = _unpacked(b.column(1))
            spans: dict[int, list] = {}
            with_seeds = np.flatnonzero(np.diff(_lists(b.column(2))[1]))
            sub = b.take(pa.array(with_seeds))
            for lo, w, at, doc, _, low, high in _marked(sub, length, seed):
                cuts = np.searchsorted(doc, np.arange(len(w.first)))
                for j in np.flatnonzero(np.diff(cuts)):
                    c = slice(cuts[j], cuts[j + 1])
                    spans[int(with_seeds[lo + j])] = [(low[c] - w.first[j], high[c] - w.first[j] + length)]
            later, off = _lists(b.column(3))
            n_words, n_removed, out = [], [], []
            for i, text in enumerate(data):
                words = text.split()
                n_words.append(len(words))
                n_removed.append(0)
                runs = later[off[i]:off[i + 1]]
                if i in spans or len(runs):
                    gone = np.zeros(len(words) + 1, np.int64)
                    for begin, end in [*spans.get(i, []), (runs, runs + length)]:
                        np.add.at(gone, begin, 1)
                        np.add.at(gone, end, -1)
                    keep = np.cumsum(gone)[:-1] == 0
                    n_removed[-1] = len(words) - int(keep.sum())
                    words = compress(words, keep.tolist())
                joined = b" ".join(words)
                out.append(joined if texts else hashlib.sha256(joined).hexdigest())
            yield pa.record_batch([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                   pa.array(out, pa.binary() if texts else pa.string()).cast(pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "text" if texts else "kept_sha256"])
    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH, seed: int = SEED_WORDS, id_col: str = "doc_id",
                     text_col: str = "text", texts: bool = True) -> DataFrame:
    """Remove every word of a run of ``length`` words that also starts earlier.

    Earlier is a smaller id, or a smaller start in the same document; runs are judged
    on the input.  Returns doc_id, n_words, n_removed and the kept ``text`` (words
    joined by one space), or its ``kept_sha256`` where ``texts`` is false.  A null or
    empty text has no words; a null id is later than none and earlier than all others
    (ids are compared as Spark orders them, null first).  Rows equal in id and text are one
    document and give one row each; texts that share an id, or have none, are documents of
    their own, in the order of their hashes (``document_key``).
    Columns other than the two named are ignored.
    """
    if not 0 < seed <= length:
        raise ValueError("seed must be between 1 and length")
    own = docs.select(document_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids = dict(own.dtypes)["doc_id"]
    seeds = own.mapInArrow(_seeds(length, seed), f"h long, doc_id {ids}, pos int")
    # grouped sides of joins are stored, so that the join shuffles both and can split a hot key
    twice = stored(seeds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "seeds")
    repeated = stored(seeds.join(twice, "h").groupBy("doc_id").agg(F.collect_set("pos").alias("seeds")), "repeated")
    packed = own.mapInArrow(_packed, f"doc_id {ids}, z binary")
    with_seeds = packed.join(repeated, packed["doc_id"].eqNullSafe(repeated["doc_id"]), "left") \
                       .select(packed["doc_id"], "z", "seeds")

    contexts = (with_seeds.where("seeds is not null")
                .mapInArrow(_contexts(length, seed), f"h long, ctx long, doc_id {ids}, pos int"))
    classes = (contexts.groupBy("h", "ctx").agg(F.min(F.struct("doc_id", "pos")).alias("f"))
               .select("h", "f.doc_id", "f.pos"))
    classes = stored(classes, "classes")
    several = stored(classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "several") \
        .withColumn("several", F.lit(True))
    firsts = (classes.join(several, "h", "left").groupBy("doc_id")
              .agg(F.collect_set("pos").alias("firsts"),
                   F.collect_set(F.when(F.col("several"), F.col("pos"))).alias("open")))

    to_compare = firsts.where(F.size("open") > 0).select("doc_id", "open")
    runs = (packed.join(to_compare, packed["doc_id"].eqNullSafe(to_compare["doc_id"]))
            .select(packed["doc_id"], "z", "open")
            .mapInArrow(_runs(length, seed), f"r1 long, r2 long, doc_id {ids}, start int"))
    first_run = stored(runs.groupBy("r1", "r2").agg(F.min(F.struct("doc_id", "start")).alias("f"), F.count("*").alias("n"))
                       .where("n > 1").select("r1", "r2", "f"), "runs")
    later = (runs.join(first_run, ["r1", "r2"])
             .where(F.struct("doc_id", "start") > F.col("f"))
             .groupBy("doc_id").agg(F.collect_set("start").alias("later")))

    marks = (firsts.select("doc_id", "firsts")
             .join(later.withColumnRenamed("doc_id", "_d"), F.col("doc_id").eqNullSafe(F.col("_d")), "full")
             .select(F.coalesce("doc_id", "_d").alias("_d"), "firsts", "later"))
    copies = F.when(F.col("firsts").isNull(), F.col("seeds")).otherwise(F.array_except("seeds", "firsts"))
    final = (with_seeds.join(marks, with_seeds["doc_id"].eqNullSafe(marks["_d"]), "left")
             .select("doc_id", "z", copies.alias("copies"), "later"))
    kept = final.mapInArrow(_kept(length, seed, texts), f"doc_id {ids}, n_words long, n_removed long, "
                            + ("text string" if texts else "kept_sha256 string"))
    return kept.select(F.col("doc_id.id").alias("doc_id"), "n_words", "n_removed", "text" if texts else "kept_sha256")
