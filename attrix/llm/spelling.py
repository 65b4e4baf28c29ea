"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the
other, which is so exactly if their common prefix and common suffix together reach the
longer length minus one.  Words are rows of padded code-point matrices; a pair of blocks
is compared column by column, which gives the common prefix and suffix of every pair.

An edit leaves the part before it or the part after it whole, so only blocks of words
that share one half are compared: a word enters the blocks of its first and of its last
half, once with its own length as the longer one and once with the next.  Blocks of more
than ``CROWDED`` words are dealt out again by three of their four quarters, and what is
still larger is cut into tiles whose pairs are compared each by itself.  A pair of words
counts only in the leftmost block that it has, so counts add up without pairs being sent.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import stored

# Fixed values of the counted words.
DROP_MODULUS = 97
MIN_POINTS = 5
MIN_COUNT = 3
FORM_RATIO = 2

DISTINCT = 500_000    # a task passes its counts on when it holds so many words
CROWDED = 1024        # larger blocks are dealt out again by quarters
TILE_CELLS = 1 << 16  # code points in a tile of a block that stays larger
SMALL = 48            # blocks up to this size are compared together
PAIRS = 1 << 17       # pairs compared at a time

_LETTERS = bytearray(b" " * 256)   # over Latin-1: A-Z lowered, letters as they are, all else a separator
for _c in (*range(0x61, 0x7B), *range(0xC0, 0x100)):
    _LETTERS[_c] = _c
for _c in range(0x41, 0x5B):
    _LETTERS[_c] = _c + 0x20
_LETTERS = bytes(_LETTERS)


def changed_words(doc_id, text: str | None) -> Counter:
    """Words of a text (Latin-1 bytes, a byte a code point) and how often they stand, after the deletions."""
    out = Counter()
    base = crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    for run, n in Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(run) < MIN_POINTS:
            continue
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), base)
        if h % DROP_MODULUS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_POINTS:
                continue
        out[run] += n
    return out


def _count(batches):
    counts = Counter()

    def out():
        yield pa.record_batch([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["w", "n"])
        counts.clear()

    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1)):
            counts.update(changed_words(doc_id.as_py(), text.as_py()))
            if len(counts) >= DISTINCT:
                yield from out()
    yield from out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(w, n): the words of ``MIN_POINTS`` code points or more that occur ``MIN_COUNT`` times or more; w is Latin-1."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(_count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


def _pieces(longer, quarters: bool) -> list[tuple]:
    """First and end code point of the pieces of a block's longer length: halves, or quarters."""
    half = F.floor(longer / 2).cast("int")
    cuts = (F.floor(half / 2).cast("int"), half, half + F.floor((longer - half) / 2).cast("int")) if quarters else (half,)
    return list(zip((F.lit(0), *cuts), (*cuts, longer)))


def _key(m, start, end):
    """What an edit from ``start`` to ``end`` of the longer word leaves: the code points before and those after."""
    w, after = F.col("w"), m - end
    return F.concat(F.substring(w, F.lit(1), start), F.substring(w, F.length(w) - after + 1, after)).alias("key")


def _blocks(words: DataFrame) -> DataFrame:
    """(m, part, key, w, n): the blocks of each word; m is the longer length, part the half that may hold the edit."""
    cells = [F.struct(m.alias("m"), F.lit(i).alias("part"), _key(m, start, end))
             for m in (F.length("w"), F.length("w") + F.lit(1)) for i, (start, end) in enumerate(_pieces(m, False))]
    return words.select("w", "n", F.explode(F.array(*cells)).alias("b")).select("b.*", "w", "n")


def _quarter_blocks(blocks: DataFrame) -> DataFrame:
    """The rows of ``blocks`` dealt out by the quarters of the half that may hold the edit."""
    m = F.col("m")
    pieces = [F.struct(F.lit(i).alias("part"), _key(m, start, end)) for i, (start, end) in enumerate(_pieces(m, True))]
    inside = F.when(F.col("part") == 0, F.array(*pieces[:2])).otherwise(F.array(*pieces[2:]))
    return blocks.select("m", F.explode(inside).alias("b"), "w", "n").select("m", "b.*", "w", "n")


def _common(x: np.ndarray, y: np.ndarray, start: int) -> np.ndarray:
    """Length of the common run of columns of any two rows that broadcast; columns before ``start`` are known to be equal."""
    alive = np.ones(np.broadcast_shapes(x.shape[:-1], y.shape[:-1]), bool)
    n = np.full(alive.shape, start, np.int32)
    for c in range(start, x.shape[-1]):
        alive &= x[..., c] == y[..., c]
        if not alive.any():
            break
        n += alive
    return n


class _Tile:
    """Words of one block as padded matrices: from their first, and from their last code point."""

    def __init__(self, words: list[bytes], m: int):
        self.size = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
        back = np.frombuffer(b"".join(w[::-1].ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
        self.flat, self.back = flat, back


def _near(flat_a, flat_b, back_a, back_b, size_a, size_b, m: int, start: int, end: int) -> np.ndarray:
    """Which pairs are one edit apart and belong to the block whose words agree outside ``start`` to ``end``."""
    shorter = np.minimum(size_a, size_b)
    both = (np.maximum(size_a, size_b) == m) & (shorter >= m - 1)
    prefix = np.minimum(_common(flat_a, flat_b, start), shorter)
    suffix = np.minimum(_common(back_a, back_b, m - end), shorter)
    near = both & (prefix + suffix >= m - 1) & (prefix < m)
    # the edit may stand at any place from m - 1 - suffix to prefix; the pair belongs to the block of the first
    first = m - 1 - suffix
    return near & (first >= start) & (first < end)


def _bounds(m: int, quarters: bool) -> tuple[int, ...]:
    half = m // 2
    return (0, half // 2, half, half + (m - half) // 2, m) if quarters else (0, half, m)


def _compare(quarters: bool):
    """Blocks, sorted, to (w, near, best): how many near words this task finds for a word, and the best of them."""
    def run(batches):
        open_key, held = None, []     # the block that the last batch left open: (w, n, tile) rows

        def solve(blocks):
            found_a, found_b = [], []
            words, counts, by_m = [], [], {}
            for (m, part, _key, i, j), rows in blocks:
                if len(rows) < 2:
                    continue
                at = len(words)
                words += [r[0] for r in rows]
                counts += [r[1] for r in rows]
                left = [at + k for k, r in enumerate(rows) if r[2] == i]
                right = left if i == j else [at + k for k, r in enumerate(rows) if r[2] == j]
                by_m.setdefault((m, part), []).append((left, right, i == j))
            if not words:
                return
            for (m, part), todo in by_m.items():
                start, end = _bounds(m, quarters)[part:part + 2]
                used = np.array(sorted({k for left, right, _ in todo for k in (*left, *right)}))
                tile = _Tile([words[k] for k in used], m)
                where = dict(zip(used.tolist(), range(len(used))))
                firsts, seconds = [], []
                for left, right, same in todo:
                    a = np.array([where[k] for k in left], np.int64)
                    b = a if same else np.array([where[k] for k in right], np.int64)
                    if not len(a) or not len(b):
                        continue
                    if len(a) <= SMALL and len(b) <= SMALL:
                        x, y = np.triu_indices(len(a), 1) if same else np.indices((len(a), len(b))).reshape(2, -1)
                        firsts.append(a[x])
                        seconds.append(b[y])
                        continue
                    step = max(1, PAIRS // len(b))
                    for lo in range(0, len(a), step):
                        p = a[lo:lo + step]
                        hit = _near(tile.flat[p][:, None], tile.flat[b][None], tile.back[p][:, None], tile.back[b][None],
                                    tile.size[p][:, None], tile.size[b][None], m, start, end)
                        x, y = np.nonzero(hit)
                        keep = p[x] < b[y] if same else slice(None)
                        found_a.append(used[p[x][keep]])
                        found_b.append(used[b[y][keep]])
                if firsts:
                    x, y = np.concatenate(firsts), np.concatenate(seconds)
                    for lo in range(0, len(x), PAIRS):
                        p, q = x[lo:lo + PAIRS], y[lo:lo + PAIRS]
                        hit = _near(tile.flat[p], tile.flat[q], tile.back[p], tile.back[q], tile.size[p], tile.size[q], m, start, end)
                        found_a.append(used[p[hit]])
                        found_b.append(used[q[hit]])
            if not found_a or not sum(map(len, found_a)):
                return
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            a, b = np.concatenate((a, b)), np.concatenate((b, a))
            names, code = np.unique(np.array(words, object), return_inverse=True)   # codes sort as the words do
            n = np.array(counts)
            order = np.lexsort((code[b], -n[b], code[a]))
            a, b = a[order], b[order]
            _, first, near = np.unique(code[a], return_index=True, return_counts=True)
            yield pa.record_batch([pa.array([words[k] for k in a[first]], pa.binary()), pa.array(near, pa.int64()),
                                   pa.array(n[b[first]], pa.int64()), pa.array([words[k] for k in b[first]], pa.binary())],
                                  names=["w", "near", "best_n", "best"])

        for batch in batches:
            m, part, key, i, j, tile, w, n = (c.to_pylist() for c in batch.columns)
            blocks = []
            for r in range(len(w)):
                k = (m[r], part[r], key[r], i[r], j[r])
                if k != open_key:
                    if open_key is not None:
                        blocks.append((open_key, held))
                    open_key, held = k, []
                held.append((w[r], n[r], tile[r]))
            yield from solve(blocks)
        if open_key is not None:
            yield from solve([(open_key, held)])
    return run


def _found(blocks: DataFrame, sizes: DataFrame, quarters: bool) -> DataFrame:
    """Near-word counts over the blocks of ``sizes`` (m, part, key, tiles)."""
    rows = (blocks.join(sizes, ["m", "part", "key"])
            .withColumn("tile", F.pmod(F.xxhash64("w"), F.col("tiles")).cast("int")))
    # a tile goes to each pair of tiles that it is in
    other = F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))
    rows = rows.select("m", "part", "key", "w", "n", "tile", F.explode(other).alias("o")).select(
        "m", "part", "key", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"), "tile", "w", "n")
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))   # few bytes, much work: not to be coalesced
    return (rows.repartition(n, "m", "part", "key", "i", "j").sortWithinPartitions("m", "part", "key", "i", "j")
            .mapInArrow(_compare(quarters), "w binary, near long, best_n long, best binary"))


def near_words(words: DataFrame, crowded: int = CROWDED, tile_cells: int = TILE_CELLS) -> DataFrame:
    """(w, n_near, best_n, best) of every word of ``words`` (w, n) that has a near word.

    ``best`` is the near word of largest n, the smallest of equal ones.  ``crowded`` and
    ``tile_cells`` change how the work is dealt out, never the result.
    """
    name = ["m", "part", "key"]
    tiles = F.ceil(F.col("c") * F.col("m") / F.lit(tile_cells)).alias("tiles")
    half = _blocks(words)
    sizes = stored(half.groupBy(*name).agg(F.count("*").alias("c")).where("c > 1"), "block_sizes")
    found = _found(half, sizes.where(F.col("c") <= crowded).select(*name, tiles), False)
    fine = stored(_quarter_blocks(half.join(sizes.where(F.col("c") > crowded), name, "left_semi")), "fine_blocks")
    fine_sizes = fine.groupBy(*name).agg(F.count("*").alias("c")).where("c > 1")
    found = found.union(_found(fine, stored(fine_sizes.select(*name, tiles), "fine_sizes"), True))
    best = F.min(F.struct((-F.col("best_n")).alias("o"), F.col("best").alias("w"))).alias("b")
    return (found.groupBy("w").agg(F.sum("near").alias("n_near"), best)
            .select("w", "n_near", (-F.col("b.o")).alias("best_n"), F.col("b.w").alias("best")))


def follow(forms: DataFrame) -> DataFrame:
    """(w, root) of every row of ``forms`` (w, form): the last word that following forms reaches.

    A form is more frequent than its word, so chains end.  Each round doubles the length that
    is followed; a round's table is written, and one count ends the loop.
    """
    at = stored(forms.select("w", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("w").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(step, "root", "left").select("w", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("w", "root")
        if not moved.where("moved").limit(1).count():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED,
                      tile_cells: int = TILE_CELLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every counted word; see ``count_words`` and ``near_words``.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that n is
    ``FORM_RATIO`` times its own or more, else null; its root follows forms to the last.  Null and
    empty texts have no words; a null id reads as ``null``.  Rows that repeat count each.  Other
    columns are ignored; a table without such words gives no rows.
    """
    words = stored(count_words(docs, id_col, text_col), "words")
    near = stored(near_words(words, crowded, tile_cells), "near")
    has_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    rows = stored(words.join(near, "w", "left").select(
        "w", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")), "variants")
    roots = follow(rows.where("form is not null").select("w", "form"))
    read = lambda c: F.decode(c, "ISO-8859-1")
    return rows.join(roots, "w", "left").select(
        read("w").alias("word"), read("form").alias("form"), read(F.coalesce("root", "w")).alias("root"), "n", "n_near", "form_n")
