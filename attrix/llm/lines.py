"""Line de-duplication: exact copies by hash, near copies by a segment-partition edit join.

Native: DataFrame functions only.  A line of at least ``min_chars`` characters is cut
into ``max_edits + 1`` segments.  Two lines within ``max_edits`` edits share one of the
shorter line's segments, and it lies in the longer at one of few places that depend on
the two lengths alone; each line looks up the substrings at those places (of every
length it may match) in an index of segments.  Candidates are verified by banded
bit-parallel edit distance.

Lines travel as 64-bit hashes until a candidate is found, equal lines are combined
before each shuffle, and an index key is looked at further only if two different lines
hold it.  Keys that many lines share are split by a second partition of what lies beside
the shared segment, so that their members are not paired with one another at large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attrix.llm.common import document_key, stored

MAX_EDITS, MIN_CHARS = 1, 20
CROWDED = 64   # lines of one key beyond which the key is refined


def segment(length: Column, parts: int, i: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` (from 1) of an even partition; the longer segments come last."""
    size = F.floor(length / F.lit(parts)).cast("int")
    longer = length - size * parts
    before = F.greatest(F.lit(0), F.lit(i - 1) - (F.lit(parts) - longer))
    return (size * (i - 1) + before + 1).cast("int"), (size + (F.lit(i) > F.lit(parts) - longer).cast("int")).cast("int")


def _places(parts: int, i: int, delta: int) -> list[int]:
    """Shifts at which segment i of a string may lie in one that is ``delta`` longer (multi-match-aware)."""
    edits = parts - 1
    low = max(-(i - 1), delta - (edits + 1 - i))
    high = min(i - 1, delta + (edits + 1 - i))
    return list(range(low, high + 1))


def _keys(line: Column, length: Column, max_edits: int, min_chars: int) -> list[Column]:
    """Structs (key, probe, delta, i, shift) of one line: its index keys and its look-ups."""
    parts = max_edits + 1
    out = []

    def entry(n, i, start, size, probe, delta, shift):
        key = F.xxhash64(n, F.lit(i), F.substring(line, start, size))
        return F.struct(key.alias("key"), F.lit(probe).alias("probe"), F.lit(delta).alias("delta"),
                        F.lit(i).alias("i"), F.lit(shift).alias("shift"))

    for i in range(1, parts + 1):
        start, size = segment(length, parts, i)
        out.append(entry(length, i, start, size, False, 0, 0))
    for delta in range(max_edits + 1):
        n = length - delta
        for i in range(1, parts + 1):
            start, size = segment(n, parts, i)
            for shift in _places(parts, i, delta):
                if delta == 0 and shift == 0:
                    continue   # an index entry is its own look-up at its own length
                at = start + shift
                fits = (n >= min_chars) & (at >= 1) & (at + size - 1 <= length)
                out.append(F.when(fits, entry(n, i, at, size, True, delta, shift)))
    return out


def edit_distance_within(a: Column, b: Column, k: int) -> Column:
    """Whether the edit distance of two arrays of more than ``k`` characters is at most ``k``: banded, bit-parallel.

    Bit b of the state stands for the character of the shorter array at i - k + b when
    character i of the longer one is read; the band has 2k + 1 bits.
    """
    short = F.when(F.size(a) <= F.size(b), a).otherwise(b)
    long = F.when(F.size(a) <= F.size(b), b).otherwise(a)
    band = (1 << (2 * k + 1)) - 1
    top, side = 1 << (2 * k), 1 << (2 * k - 1) if k else 0
    bit = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0))
    inv = lambda c: c.bitwiseXOR(F.lit(band))

    packed = F.struct(short.alias("s"), long.alias("l"))

    def distance(p: Column) -> Column:
        s, t = p["s"], p["l"]
        n = F.size(s)

        def step(state: Column, i: Column) -> Column:
            vp, vn, d, h = state["vp"], state["vn"], state["d"], state["h"]
            c = F.get(t, i)
            x = F.lit(0)
            for b in range(2 * k + 1):
                at = i + (b - k)
                x = x.bitwiseOR(bit(F.coalesce((at >= 0) & (at < n) & (F.get(s, F.greatest(at, F.lit(0))) == c), F.lit(False)), 1 << b))
            d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(F.lit(band))
            stay = F.struct(d0.alias("d0"), vp.alias("vp"), vn.alias("vn"), d.alias("d"), h.alias("h"), i.alias("i"))
            # the nested transform binds d0, hp and hn to names, so that each is computed once
            return F.get(F.transform(F.array(stay), lambda q: _move(q, n)), F.lit(0))

        def _move(q: Column, n: Column) -> Column:
            hp = q["vn"].bitwiseOR(inv(q["d0"].bitwiseOR(q["vp"])))
            hn = q["d0"].bitwiseAND(q["vp"])
            shifted = F.shiftright(q["d0"], 1)
            diagonal = q["i"] < n - k
            down = q["d"] + F.when(q["d0"].bitwiseAND(F.lit(top)) == 0, 1).otherwise(0)
            across = (q["d"] + F.when(hp.bitwiseAND(q["h"]) != 0, 1).otherwise(0)
                      - F.when(hn.bitwiseAND(q["h"]) != 0, 1).otherwise(0))
            return F.struct(hn.bitwiseOR(inv(shifted.bitwiseOR(hp))).alias("vp"), shifted.bitwiseAND(hp).alias("vn"),
                            F.when(diagonal, down).otherwise(across).alias("d"),
                            F.when(diagonal, q["h"]).otherwise(F.shiftright(q["h"], 1)).alias("h"))

        start = F.struct(F.lit(band & ~((1 << k) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(k).alias("d"), F.lit(side).alias("h"))
        return F.when(F.size(t) - n > k, False).otherwise(
            F.aggregate(F.sequence(F.lit(0), F.size(t) - 1), start, step, lambda s: s["d"] <= k))

    if k == 0:
        return a == b
    return F.get(F.transform(F.array(packed), distance), F.lit(0))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, ln, line, h) of every line that is not blank; ``ln`` counts from 0."""
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
            .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("h", F.xxhash64("line")))


def _near(rows: DataFrame) -> DataFrame:
    """Candidate pairs (a < b) of line hashes from rows of live keys; see ``_keys`` for their columns."""
    index, probe = rows.where("not probe"), rows.where("probe")
    right = index.select("key", F.col("h").alias("b"))
    same = index.select("key", F.col("h").alias("a")).join(right, "key").where("a < b").select("a", "b")
    other = (probe.select("key", F.col("h").alias("a")).join(right, "key").where("a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return same.union(other)


def _refined(rows: DataFrame, max_edits: int) -> DataFrame:
    """Rows of crowded keys (with ``line``) -> rows of finer keys.

    Beside a shared segment i at most i - 1 edits lie to its left and max_edits + 1 - i to its
    right; the side with more of them is partitioned as the line was.
    """
    parts, length = max_edits + 1, F.char_length("line")
    combos = sorted({(False, 0, i, 0) for i in range(1, parts + 1)}
                    | {(True, d, i, s) for d in range(parts) for i in range(1, parts + 1) for s in _places(parts, i, d) if d or s})
    finer = []
    for probe, delta, i, shift in combos:
        left, edits = i - 1 > parts - i, max(i - 1, parts - i)
        start, size = segment(length - delta, parts, i)
        begin, end = (F.lit(1), start + shift) if left else (start + shift + size, length + 1)
        d = shift if left else delta - shift          # how much longer the side is than the index line's
        n = end - begin - d                           # the index line's side
        cells = []
        for j in range(1, edits + 2):
            at, m = segment(n, edits + 1, j)
            low = max(-(j - 1), d - (edits + 1 - j))
            high = min(j - 1, d + (edits + 1 - j))
            for s in range(low, high + 1):
                fits = (at + s >= 1) & (at + s + m - 1 <= end - begin)
                # an index row also looks up the index at the other places of its own length
                cells.append(F.when(fits, F.struct(F.xxhash64("key", F.lit(j), F.substring("line", begin + at + s - 1, m)).alias("key"),
                                                   F.lit(probe or s != 0).alias("probe"))))
        finer.append(F.when((F.col("probe") == probe) & (F.col("delta") == delta) & (F.col("i") == i) & (F.col("shift") == shift),
                            F.array(*cells)))
    return rows.select("h", F.explode(F.coalesce(*finer)).alias("k")).where("k is not null").select("k.key", "k.probe", "h").distinct()


def _live(rows: DataFrame) -> DataFrame:
    """The keys that an index entry and another line share."""
    return stored(rows.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.when(~F.col("probe"), 1)).alias("n"))
                  .where("lo < hi and n > 0").select("key"), "live")


def duplicate_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, crowded: int = CROWDED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ln) of every line that is removed; ``ln`` counts the lines of a text from 0.

    A line goes if an equal line starts earlier (smaller id, or smaller line number in the same
    text), or if both have ``min_chars`` characters or more and a line within ``max_edits`` edits
    starts earlier; lines are judged on the input.  Blank lines stay and match nothing.  Null
    texts have no lines; null ids come first.  Rows equal in id and text are one document, whose
    lines of one number start together; texts that share an id, or have none, are documents of
    their own, in the order of their hashes (``document_key``).  Other columns are ignored.
    """
    gone = _duplicates(docs, max_edits, min_chars, crowded, id_col, text_col)
    return gone.select(F.col("doc_id.id").alias("doc_id"), "ln")


def _duplicates(docs: DataFrame, max_edits: int, min_chars: int, crowded: int, id_col: str, text_col: str) -> DataFrame:
    """As ``duplicate_lines``, with the ``document_key`` as doc_id."""
    if not 0 <= max_edits < min_chars:
        raise ValueError("min_chars must exceed max_edits, which must not be negative")
    own = docs.select(document_key(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = _lines(own)
    at = F.struct("doc_id", "ln")
    # equal lines: two hashes and the length stand for the text
    marks = stored(lines.select("doc_id", "ln", "h", F.xxhash64(F.lit("g"), "line").alias("g"), F.octet_length("line").alias("m")), "lines")
    first = stored(marks.groupBy("h", "g", "m").agg(F.min(at).alias("first"), F.count("*").alias("n"))
                   .where("n > 1").select("h", "g", "m", "first"), "first")
    gone = marks.join(first, ["h", "g", "m"]).where(at > F.col("first")).select("doc_id", "ln")
    if not max_edits:
        return gone.distinct()

    length = F.char_length("line")
    rows = (lines.where(length >= min_chars)
            .select("h", F.explode(F.array(*_keys(F.col("line"), length, max_edits, min_chars))).alias("k"))
            .where("k is not null").select("h", "k.*"))
    rows = stored(rows, "keys")     # their making costs more than reading them again
    live = _live(rows)
    rows = stored(rows.join(live, "key", "left_semi").distinct(), "rows")
    wanted = rows.select("h").distinct()
    found = stored(lines.where(length >= min_chars).join(stored(wanted, "wanted"), "h", "left_semi"), "found")
    texts = stored(found.groupBy("h", "line").agg(F.min(at).alias("first")), "texts")

    size = rows.groupBy("key").agg(F.count(F.when(~F.col("probe"), 1)).alias("a"), F.count("*").alias("b"))
    full = stored(size.where(F.col("a") * F.col("b") > crowded * crowded).select("key"), "crowded")
    pairs = _near(rows.join(full, "key", "left_anti"))
    fine = _refined(rows.join(full, "key", "left_semi").join(texts.select("h", "line"), "h"), max_edits)
    fine = stored(fine, "fine")
    pairs = pairs.union(_near(fine.join(_live(fine), "key", "left_semi"))).distinct()

    side = lambda x: texts.select(F.col("h").alias(x), F.col("line").alias(f"l{x}"), F.col("first").alias(f"f{x}"))
    linked = stored(pairs.join(side("a"), "a").join(side("b"), "b")
                    .where(edit_distance_within(F.split("la", ""), F.split("lb", ""), max_edits)), "linked")
    earlier = (linked.select(F.col("a").alias("h"), F.col("la").alias("line"), F.col("fb").alias("first"))
               .union(linked.select("b", "lb", "fa")).groupBy("h", "line").agg(F.min("first").alias("first")))
    near = (found.join(stored(earlier, "earlier"), ["h", "line"]).where(at > F.col("first")).select("doc_id", "ln"))
    return gone.union(near).distinct()


def _grouped(gone: DataFrame) -> DataFrame:
    """The removed line numbers of each document, as ``removed`` by ``d``."""
    return gone.groupBy(F.col("doc_id").alias("d")).agg(F.sort_array(F.collect_set("ln")).alias("removed"))


def dedup_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_removed and the removed line numbers (from 0, sorted); see ``duplicate_lines``."""
    gone = _grouped(_duplicates(docs, max_edits, min_chars, CROWDED, id_col, text_col))
    own = docs.select(document_key(id_col, text_col).alias("d"), F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)).cast("long").alias("n_lines"))
    own = own.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    return (own.join(gone, "d", "left")
            .select(F.col("d.id").alias("doc_id"), "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def remove_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) without the removed lines; ``n_chars``, if there, counts what is left.

    A document whose lines all go keeps its row, with an empty text.
    """
    gone = _grouped(_duplicates(docs, max_edits, min_chars, CROWDED, "doc_id", "text"))
    rows = docs.select(F.struct("*").alias("row"), document_key().alias("d")).join(gone, "d", "left")
    old, removed = F.col("row.text"), F.col("removed")
    kept = F.array_join(F.filter(F.split(old, "\n"), lambda x, i: ~F.array_contains(removed, i)), "\n")
    changed = {"text": F.when(removed.isNull(), old).otherwise(kept)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(removed.isNull(), F.col("row.n_chars")).otherwise(
            F.char_length(kept).cast(dict(docs.dtypes)["n_chars"]))
    # in a struct first: a column of the caller's may be called as one of those above
    return rows.select(F.struct(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns]).alias("new")).select("new.*")
