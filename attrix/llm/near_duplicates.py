"""Near-duplicate documents: SuperMinHash, banding, verification on full sets, union-find.

A document's set holds its distinct shingles.  Equal sets form a class with one
representative; only representatives are signed and compared.  A SuperMinHash signature
gives every shingle a random permutation of the slots, of which rank j carries a value
in [j, j + 1): the slot minima have less variance than independent hashes, and a
document is finished as soon as all its slots hold values below the next rank.

Candidates share a band.  A band bucket of any size costs a row per member: each
document is first verified against the bucket leader with which it shares most bands.
Members of one bucket whom these links leave in different components may still be
linked.  All such documents are compared by prefix filtering, which is exact: with the
shingles of each set ordered from rare to frequent among them, two sets over the
threshold share one of the first few.  So no candidate link between components is lost,
and copies that are each too far from the others are not paired at large: the edits
that set them apart come first in that order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from attrix.llm.common import stored
from attrix.llm.components import components
from attrix.llm.words import SPACE_WORD, find_words, mix, run_hashes, signed, slices

SHINGLE = 5
PERCENT = 75
SLOTS, ROWS = 128, 4   # 32 bands: a pair at 0.75 shares none with probability (1 - 0.75^4)^32, 5 in a million
SLICE = 1 << 19   # bytes of texts worked on at a time


def shingles(w, size: int = SHINGLE):
    """Distinct shingle hashes of each document: (document index, hash), sorted by both."""
    n = np.minimum(w.n_words, size)
    count = np.where(n > 0, w.n_words - n + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)))[:-1], count) + w.first[:-1][doc]
    h = run_hashes(w.hash, at, n[doc], 3)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def super_minhash(doc: np.ndarray, h: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n_docs x slots) of the sets given as sorted (document, hash) rows.

    All elements of all unfinished documents take their rank-j step together; a value is
    rank * 2^32 + 32 random bits.
    """
    sig = np.full(n_docs * slots, np.iinfo(np.int64).max)
    live = np.bincount(doc, minlength=n_docs) > 0
    perm = np.zeros((0, slots), np.uint8 if slots <= 256 else np.int32)
    for j in range(slots):
        x = mix(h + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot, first = k, k
        else:
            rows = np.arange(len(h))
            slot = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        value = (x >> np.uint64(32)).astype(np.int64) + (j << 32)
        np.minimum.at(sig, doc * slots + slot, value)
        finished = sig.reshape(n_docs, slots).max(1) < (j + 1) << 32
        stay = (live & ~finished)[doc]
        if not stay.any():
            break
        if j == 0:
            doc, h, first = doc[stay], h[stay], first[stay]
            perm = np.tile(np.arange(slots, dtype=perm.dtype), (len(h), 1))
            perm[np.arange(len(h)), first] = 0   # the first step swapped slot 0 in
        elif not stay.all():
            doc, h, perm = doc[stay], h[stay], perm[stay]
    return sig.reshape(n_docs, slots)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per band, the band's number included."""
    n, slots = sig.shape
    parts = mix(sig.view(np.uint64)).reshape(n, slots // rows, rows)
    key = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key


def _signed(size: int, slots: int, rows: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), SLICE):
                w = find_words(data, off, SPACE_WORD, fold=True)
                doc, h = shingles(w, size)
                n = np.bincount(doc, minlength=hi - lo)
                s1, s2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                np.add.at(s1, doc, mix(h ^ np.uint64(0x5851F42D4C957F2D)))
                np.add.at(s2, doc, mix(h ^ np.uint64(0x14057B7EF767814F)))
                keys = signed(band_keys(super_minhash(doc, h, hi - lo, slots), rows))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * keys.shape[1]),
                                                 pa.array(keys.ravel()))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                                       pa.array(signed(s1)), pa.array(signed(s2)), bands],
                                      names=["doc_id", "n", "s1", "s2", "bands"])
    return run


def _sets(size: int):
    """The sorted shingle hashes of each document, as bytes."""
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), SLICE):
                doc, h = shingles(find_words(data, off, SPACE_WORD, fold=True), size)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo),
                                       pa.array([h[cut[i]:cut[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())],
                                      names=["doc_id", "s"])
    return run


def _linked(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _tokens(batches):
    """(doc_id, set) -> a row per shingle."""
    for b in batches:
        raw, n = b.column(1), []
        for x in raw:
            n.append(len(x.as_buffer()) // 8)
        t = np.frombuffer(b"".join(x.as_buffer() for x in raw), np.int64)
        yield pa.record_batch([b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), n))), pa.array(t)], names=["rep", "t"])


def _rare_pairs(members: DataFrame, sets: DataFrame, percent: int, ids: str) -> DataFrame:
    """Pairs a, b of ``members`` (rep, n, c: distinct, of several components c) that may be linked across components.

    Sets x and y over the threshold share at least ``share * (|x| + |y|)`` shingles.  Partners are
    sought per class of sizes (each a tenth larger than the last), for which that bounds how
    many of x's rarest shingles must hold a common one.  Shingles of one member alone come
    first and match nothing, so only their number counts.
    """
    share, base = percent / (100 + percent), 1.1
    tokens = (sets.join(members.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
              .mapInArrow(_tokens, f"rep {ids}, t long"))
    df = stored(tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    size_class = lambda n: F.floor(F.log(n) / F.lit(float(np.log(base))) + 1e-9).cast("int")
    own = Window.partitionBy("rep")
    position = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "t")) - 1
    low = F.greatest(F.lit(1.0), F.floor(F.pow(F.lit(base), F.col("other"))))   # no larger than any size of the class
    enough = F.ceil((F.col("n") + low) * share - 1e-9)
    first = F.floor(F.col("n") * (1 - percent / 100) + 1e-9)   # the longest prefix that any partner asks for
    rows = (tokens.join(df, "t").join(members, "rep").withColumn("p", position).where(F.col("p") <= first)
            .withColumn("own", size_class(F.col("n")))
            .withColumn("other", F.explode(F.sequence(size_class(F.greatest(F.lit(1.0), F.col("n") * (percent / 100) - 1)),
                                                      size_class(F.col("n") * (100 / percent) + 1))))
            .where(F.col("p") <= F.col("n") - enough).select("t", "own", "other", "rep", "n", "c", "p"))
    rows = stored(rows, "prefixes")
    x = rows.select("t", "own", "other", *[F.col(k).alias(k + "a") for k in ("rep", "n", "c", "p")])
    y = rows.select("t", F.col("own").alias("other"), F.col("other").alias("own"),
                    *[F.col(k).alias(k + "b") for k in ("rep", "n", "c", "p")])
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return (x.join(y, ["t", "own", "other"]).where(F.col("ca") < F.col("cb")).where(left >= (F.col("na") + F.col("nb")) * share - 1e-9)
            .select(F.col("repa").alias("a"), F.col("repb").alias("b")).distinct())


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, slots: int = SLOTS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable) and kept (doc_id = component_id).

    Documents are linked if 100 * intersection >= percent * union of their sets of ``size``-word
    shingles (A-Z lower-cased; a shorter text is one shingle).  Texts that are null, empty or
    without words are linked with nothing.  Ids identify documents: the texts of rows that repeat an id
    are one node.  A row with a null id is linked with nothing, has a null component and is kept.  Columns
    other than the two named are ignored.
    """
    ids = dict(docs.dtypes)[id_col]
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sig = stored(own.mapInArrow(_signed(size, slots, rows), f"doc_id {ids}, n long, s1 long, s2 long, bands array<long>"), "signatures")
    some = sig.where("n > 0 and doc_id is not null")
    # grouped sides of joins are stored, so that the join shuffles both and can split a hot key
    classes = stored(some.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")), "classes")
    buckets = classes.select("rep", "n", F.explode("bands").alias("key"))
    leaders = stored(buckets.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("f"), F.count("*").alias("c"))
                     .where("c > 1").select("key", F.col("f.rep").alias("lead"), F.col("f.n").alias("lead_n")), "leaders")
    shared = stored(buckets.join(leaders, "key"), "buckets")
    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(own.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(size), f"doc_id {ids}, s binary"), "sets")

    near = lambda n, m: 100 * F.least(F.col(n), F.col(m)) >= percent * F.greatest(F.col(n), F.col(m))

    def links(pairs: DataFrame) -> DataFrame:
        full = (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), "b")
                .join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), "a").select("a", "b", "sa", "sb"))
        return stored(full.mapInArrow(_linked(percent), f"a {ids}, b {ids}").distinct(), "links")

    best = (shared.where((F.col("rep") != F.col("lead")) & near("n", "lead_n")).groupBy("rep", "lead").agg(F.count("*").alias("c"))
            .groupBy("rep").agg(F.max(F.struct("c", "lead")).alias("m"))
            .select(F.col("m.lead").alias("a"), F.col("rep").alias("b")))
    found = links(best)
    comp = components(found)

    def placed(df: DataFrame, col: str, out: str) -> DataFrame:
        c = comp.select(F.col("node").alias("_n"), F.col("comp").alias("_c"))
        return df.join(c, F.col(col) == F.col("_n"), "left").withColumn(out, F.coalesce("_c", col)).drop("_n", "_c")

    member = stored(placed(shared.select("key", "rep", "n"), "rep", "c"), "members")
    split = stored(member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key"), "split")
    apart = stored(member.join(split, "key", "left_semi").select("rep", "n", "c").distinct(), "apart")
    last = links(_rare_pairs(apart, sets, percent, ids))
    place = classes.select("s1", "s2", "n", "rep")
    rows = sig.select("doc_id", "n", "s1", "s2").join(place, ["s1", "s2", "n"], "left")
    several = rows.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("doc_id")
    same_id = rows.where("rep <> doc_id").join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comp = components(found.union(last).union(same_id))
    out = placed(rows.withColumn("rep", F.coalesce("rep", "doc_id")), "rep", "component_id")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
