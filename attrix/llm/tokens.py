"""Token counts without token ids: pieces are counted once per distinct pre-token.

Pass one counts the pre-tokens of the corpus (each task sums its own first), and the
library splits each distinct pre-token into pieces once.  Pass two joins the
per-document frequencies to those counts and sums.  The most frequent pre-tokens,
which would be the hot keys of that join, are a broadcast table of at most ``HOT``
entries of ``HOT_BYTES`` bytes each; a task sums them on the spot, and only
frequencies of the rest are shuffled.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import stored
from attrix.llm.words import signed, slices, span_hashes

HOT, HOT_BYTES = 1 << 18, 64
DISTINCT = 400_000   # a task passes its sums on when it holds so many pre-tokens
MAX_TOKENS = 2048
_MARK = "\x00"       # starts the keys of per-document figures; a text's own NULs are never first in a key, see _key


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class PreTokenizer:
    """The pre-tokens of a text, as the library at ``path`` (a tokenizers .json) cuts them.

    The usual shape - NFC, white space to a space, lower case, then the matches of one
    pattern - runs as a pattern search; any other goes through the library's own normaliser
    and pre-tokenizer.  Special strings in a text are cut out first and are a piece each.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        norm, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        steps = [n["type"] for n in norm.get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        self.pattern = None
        if (steps == ["NFC", "Replace", "Lowercase"] and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"} and len(parts) == 2
                and parts[0]["type"] == "Split" and parts[0]["behavior"] == "Removed" and parts[0]["invert"]
                and parts[1]["type"] == "ByteLevel" and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]):
            self.pattern = regex.compile(parts[0]["pattern"]["Regex"])
        plain = all(not a[k] for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if self.special and not plain:
            raise ValueError("added tokens with strip, single-word or normalised matching are not supported")
        if self.pattern is None and not _library(path).pre_tokenizer:
            raise ValueError("the tokenizer has no pre-tokenizer")

    def _cut(self, text: str) -> list[str]:
        if self.pattern is not None:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # the library lowers letters one by one
            return self.pattern.findall(text.lower())
        t = _library(self.path)
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text) if t.normalizer else text)]

    def __call__(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings."""
        if self.cut is None or not (found := self.cut.findall(text)):
            return self._cut(text), 0
        return [p for part in self.cut.split(text) for p in self._cut(part)], len(found)

    def pieces(self, tokens: list[str]) -> list[int]:
        """Number of pieces of each pre-token."""
        t = _library(self.path)
        if self.pattern is not None:
            return [len(e.ids) for e in t.encode_batch(tokens, add_special_tokens=False)]
        return [len(t.model.tokenize(p)) for p in tokens]


def _key(token: str) -> str:
    return _MARK + _MARK + token if token.startswith(_MARK) else token


def _frequencies(path: str):
    def run(batches):
        cut, counts = PreTokenizer(path), Counter()

        def out():
            yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["p", "c"])
            counts.clear()

        for b in batches:
            for text in b.column(0):
                if text.is_valid:
                    counts.update(cut(text.as_py())[0])
                if len(counts) >= DISTINCT:
                    yield from out()
        yield from out()
    return run


def _pieces(path: str):
    def run(batches):
        cut = PreTokenizer(path)
        for b in batches:
            tokens = b.column(0).to_pylist()
            yield pa.record_batch([pa.array([_key(t) for t in tokens], pa.string()), b.column(1),
                                   pa.array(cut.pieces(tokens), pa.int64())], names=["p", "c", "n"])
    return run


def _documents(path: str, hot):
    """Rows (doc_id, t, p, f): frequencies of rare pre-tokens, and per document its sum so far and its bytes."""
    def run(batches):
        cut, known = PreTokenizer(path), hot.value
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                t = signed(span_hashes(data, off[:-1], off[1:])).tolist()
                at, key, freq = [], [], []
                for i, text in enumerate(b.column(1).slice(lo, hi - lo)):
                    tokens, total = cut(text.as_py()) if text.is_valid else ([], 0)
                    rare = []
                    for token in tokens:
                        n = known.get(token)
                        if n is None:
                            rare.append(token)
                        else:
                            total += n
                    rare = Counter(rare)
                    salt = str(t[i] & 4095)   # these keys meet no pre-token; the salt spreads them
                    key += [f"{_MARK}t{salt}", f"{_MARK}b{salt}", *map(_key, rare)]
                    freq += [total, int(off[i + 1] - off[i]), *rare.values()]
                    at += [i] * (2 + len(rare))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo).take(pa.array(at, pa.int64())),
                                       pa.array([t[i] for i in at], pa.int64()), pa.array(key, pa.string()),
                                       pa.array(freq, pa.int64())], names=["doc_id", "t", "p", "f"])
    return run


def most_frequent(pieces: DataFrame, hot: int) -> DataFrame:
    """At most ``hot`` rows: those whose count c is over a bound that a histogram of the counts gives.

    No task sees more than its share: the histogram has eight classes for each power of two, and a
    class that would pass ``hot`` stays out with all below it, which costs speed and changes no count.
    """
    size = F.floor(F.log2("c") * 8).cast("int")
    classes = pieces.groupBy(size.alias("s")).agg(F.count("*").alias("n")).collect()      # at most 504 rows
    low, held = None, 0
    for s, n in sorted(((r["s"], r["n"]) for r in classes), reverse=True):
        if held + n > hot:
            break
        low, held = s, held + n
    return pieces.where(size >= low if low is not None else F.lit(False))


def count_tokens(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, hot: int = HOT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: n_bytes, n_tokens, and over_limit (more than ``max_tokens``).

    Counts equal the library's, without begin, end or added special tokens; special strings
    inside a text count as the library counts them by default.  A null or empty text has no
    tokens.  Rows that repeat an id, with the same text or another, give one row each.
    Columns other than the two named are ignored.  ``path`` must be readable on the executors.
    """
    ids = dict(docs.dtypes)[id_col]
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = (own.select("text").mapInArrow(_frequencies(path), "p string, c long")
               .groupBy("p").agg(F.sum("c").alias("c")))
    pieces = stored(counted.mapInArrow(_pieces(path), "p string, c long, n long"), "pieces")
    top = most_frequent(pieces.where((F.octet_length("p") <= HOT_BYTES) & ~F.col("p").startswith(_MARK)), hot).select("p", "n").toArrow()
    known = own.sparkSession.sparkContext.broadcast(dict(zip(top["p"].to_pylist(), top["n"].to_pylist())))
    rows = own.mapInArrow(_documents(path, known), f"doc_id {ids}, t long, p string, f long")
    kind = lambda k: F.col("p").startswith(_MARK + k)
    figures = (rows.join(pieces.select("p", "n"), "p", "left")
               .groupBy("doc_id", "t")
               .agg(F.count(F.when(kind("b"), 1)).alias("m"), F.sum(F.when(kind("b"), F.col("f"))).alias("b"),
                    F.sum(F.when(kind("b"), 0).when(kind("t"), F.col("f")).otherwise(F.col("f") * F.col("n"))).alias("n")))
    # m rows had this id and text: each has an equal share of the sums
    return (figures.select("doc_id", F.expr("b div m").alias("n_bytes"), F.expr("n div m").alias("n_tokens"),
                           F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("_i")).drop("_i")
            .withColumn("over_limit", F.col("n_tokens") > max_tokens))
