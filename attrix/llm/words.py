"""Word boundaries and word hashes of a batch of texts, in numpy.

All tasks of the subpackage that look at words work on the UTF-8 bytes of an
Arrow string column.  A word class is a set of bytes (separators are ASCII, so
the bytes of a multi-byte character never split a word), and the hash of a
span is a difference of prefix sums of a polynomial over Z/2^64, so every word
and every n-gram of a batch is hashed with a fixed number of vector operations.

Nulls count as empty texts.  Texts are handled whole: a batch is cut between
documents only, and a text longer than ``SLICE_BYTES`` is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

# Fixed hash parameters: a change makes stored fingerprints incomparable.
_BYTE_SEED = 20240229
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_Q = np.uint64(0xD6E8FEB86659FD93 | 1)

SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x80:] = True
ALNUM_WORD[0x30:0x3A] = True
ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x41:0x5B] = True  # A-Z count as the letters they fold to


def _byte_values(fold: bool) -> np.ndarray:
    v = np.random.default_rng(_BYTE_SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold:
        v[0x41:0x5B] = v[0x61:0x7B]
    return v


_VALUES = {False: _byte_values(False), True: _byte_values(True)}


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            up, down = np.full(n, self.base), np.full(n, self.inverse)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_BYTES, _GRAMS = _Powers(_P), _Powers(_Q)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


@dataclass
class Words:
    """Words of one slice: ``first[i]:first[i + 1]`` are those of document i."""

    data: np.ndarray      # bytes of all texts, back to back
    offsets: np.ndarray   # of the texts in ``data``, one more than documents
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # byte after each word
    first: np.ndarray     # index of each document's first word, one more than documents
    doc: np.ndarray       # document index of each word
    hash: np.ndarray | None

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)


def _buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_binary(col.type)):
        col = col.cast(pa.large_string() if not pa.types.is_large_binary(col.type) else col.type)
    if col.null_count:
        col = col.fill_null(b"" if "binary" in str(col.type) else "")
    wide = str(col.type).startswith("large_")
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    off = off.astype(np.int64) if len(off) else np.zeros(1, np.int64)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    data, off = _buffers(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def byte_slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``slices``, of a list of byte strings."""
    lo, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (size and size + len(texts[i]) > limit):
            part = texts[lo:i]
            off = np.concatenate(([0], np.cumsum([len(t) for t in part]))).astype(np.int64)
            yield lo, i, np.frombuffer(b"".join(part), np.uint8), off
            lo, size = i, 0
        if i < len(texts):
            size += len(texts[i])


def byte_totals(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[fold][data] * _BYTES.get(len(data) + 1)[0][:len(data)], out=total[1:])
    return total


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False,
                total: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    total = byte_totals(data, fold) if total is None else total
    raw = (total[end] - total[start]) * _BYTES.get(len(data) + 1)[1][start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: bool = False,
               hashes: bool = True) -> Words:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    begins = inside[1:-1] > inside[:-2]
    ends = inside[1:-1] > inside[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = inside[inner + 1] > 0        # a text's first byte starts a word
    ends[inner - 1] = inside[inner] > 0          # and its last byte ends one
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, first, doc,
                 span_hashes(data, start, end, fold) if hashes else None)


def gram_hashes(h: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive values (``len(h) - n + 1`` of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    return run_hashes(h, np.arange(len(h) - n + 1), n, salt)


def run_hashes(h: np.ndarray, at: np.ndarray, n, salt: int = 0) -> np.ndarray:
    """Hash of the n values from each position ``at``; n may be an array."""
    up, down = _GRAMS.get(len(h) + 1)
    if salt:
        h = mix(h + np.uint64(salt * 0xA24BAED4963EE407 & 0xFFFFFFFFFFFFFFFF))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=total[1:])
    lengths = np.asarray(n, dtype=np.int64).astype(np.uint64)
    return mix((total[at + n] - total[at]) * down[at] + lengths * np.uint64(0x632BE59BD9B4E019))


def whole_grams(w: Words, n: int) -> np.ndarray:
    """Whether the n-gram that starts at each word stays in its document."""
    return w.first[w.doc + 1] - np.arange(len(w.doc)) >= n


def anchors(h: np.ndarray, first: np.ndarray, doc: np.ndarray, whole: np.ndarray, length: int, seed: int):
    """Winnowing: the smallest hash of ``seed`` words in every run of ``length`` words.

    Returns the anchors' positions, documents and hashes, and the first and last run start
    that chose each.  Equal runs choose the same place.  ``whole`` says for each word whether a run of ``length`` words starts there.
    """
    whole = whole[:max(0, len(h) - length + 1)]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    grams = gram_hashes(h, seed)
    span = length - seed + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, span)[:len(whole)]
    chosen = starts + (views[starts] if len(starts) < len(whole) else views).argmin(1)
    at, low, n = np.unique(chosen, return_index=True, return_counts=True)  # the leftmost smallest never moves back
    return at, doc[at], grams[at], starts[low], starts[low + n - 1]
