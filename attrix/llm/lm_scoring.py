"""Masked pseudo-likelihood scores of documents.

Every token (word) is hidden in turn and predicted from the tokens on both sides by a
small network: embeddings of the left and the right neighbour, a tanh layer, a softmax
over classes, which are the corpus' most frequent words and hash buckets for all others.
A word of a bucket then has its share of the bucket's probability, by its count among all
the corpus' words (plus one, so that unseen words have some): the words that are gathered
and told apart grow with the corpus, only the network's classes do not.

With one neighbour a side the corpus enters the network's likelihood only through the
counts of (left, token, right), so Spark counts these over every whole text and the
network is trained in numpy on the whole corpus at once: full-batch gradients over at most
``classes ** 2`` contexts.  A document's score is the sum of its tokens' conditional
log-probabilities.  Word counts stay in a table: the most frequent, ``HOT`` at most, are
broadcast, and a document's other words are counted and joined to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import stored
from attrix.llm.tokens import most_frequent
from attrix.llm.words import ALNUM_WORD, find_words, mix, signed, slices, span_hashes

TOP_WORDS, BUCKETS = 95, 32
WIDTH, STEPS, RATE = 32, 150, 0.05
HOT = 1 << 18       # words that are broadcast at most; it changes no score
MERGE = 1_000_000   # a task merges its word counts when it holds so many


def _merged(parts):
    h, i = np.unique(np.concatenate([a for a, _ in parts]), return_inverse=True)
    return h, np.bincount(i, np.concatenate([c for _, c in parts]), len(h)).astype(np.int64)


def _word_counts(batches):
    parts, held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0

    def out(h, n):
        for k in range(0, len(h), 100_000):
            yield pa.record_batch([pa.array(signed(h[k:k + 100_000])), pa.array(n[k:k + 100_000])], names=["h", "n"])

    for b in batches:
        for _, _, data, off in slices(b.column(0)):
            parts.append(np.unique(find_words(data, off, ALNUM_WORD, fold=True).hash, return_counts=True))
            held += len(parts[-1][0])
        if held > MERGE:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > MERGE:
                yield from out(*parts[0])
                parts, held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    yield from out(*_merged(parts))


@dataclass
class Vocabulary:
    """0 is a text's edge, then the listed words (sorted hashes), then the buckets."""

    words: np.ndarray
    buckets: int

    @property
    def size(self) -> int:
        return 1 + len(self.words) + self.buckets

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = (1 + len(self.words) + (mix(h) % np.uint64(self.buckets)).astype(np.int64)).astype(np.int32)
        if len(self.words):
            i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            known = self.words[i] == h
            out[known] = 1 + i[known]
        return out

    def windows(self, data: np.ndarray, offsets: np.ndarray):
        """Document, left neighbour, token and right neighbour of every token of a slice."""
        w = find_words(data, offsets, ALNUM_WORD, fold=True)
        token = self.ids(w.hash)
        left, right = np.zeros_like(token), np.zeros_like(token)
        left[1:], right[:-1] = token[:-1], token[1:]
        some = w.n_words > 0
        left[w.first[:-1][some]] = 0
        right[w.first[1:][some] - 1] = 0
        return w, left, token, right


def _window_counts(vocabulary: Vocabulary):
    def run(batches):
        v = vocabulary.size
        counts = np.zeros(v ** 3, np.int64)
        for b in batches:
            for _, _, data, off in slices(b.column(0)):
                _, left, token, right = vocabulary.windows(data, off)
                np.add.at(counts, (left.astype(np.int64) * v + right) * v + token, 1)
        seen = np.flatnonzero(counts)
        for k in range(0, len(seen), 100_000):
            part = seen[k:k + 100_000]
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(counts[part])], names=["w", "n"])
    return run


@dataclass
class WindowNetwork:
    """p(class | left, right) = softmax(tanh(left embedding + right embedding) . output + bias).

    ``counts`` is the table (h, n) of the corpus' words and ``mass`` the sum of n + 1 over a
    bucket's words, plus one; without them a word scores as its class.
    """

    vocabulary: Vocabulary
    left: np.ndarray
    right: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    counts: DataFrame | None = None
    mass: np.ndarray | None = None

    def log_table(self) -> np.ndarray:
        """Log-probabilities of every token in every context, indexed (left * V + right) * V + token."""
        v = self.vocabulary.size
        out = np.empty((v * v, v), np.float32)
        for a in range(v):
            z = np.tanh(self.left[a] + self.right) @ self.output + self.bias
            z -= z.max(1, keepdims=True)
            out[a * v:(a + 1) * v] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out.ravel()


def train(vocabulary: Vocabulary, window: np.ndarray, count: np.ndarray, width: int = WIDTH, steps: int = STEPS,
          rate: float = RATE, seed: int = 7) -> WindowNetwork:
    """Adam on the mean conditional log-probability of all counted windows."""
    v = vocabulary.size
    rng = np.random.default_rng(seed)
    p = {"left": rng.normal(0, 0.3, (v, width)), "right": rng.normal(0, 0.3, (v, width)),
         "output": rng.normal(0, 0.1, (width, v)), "bias": np.zeros(v)}
    p = {k: x.astype(np.float32) for k, x in p.items()}
    total = float(count.sum())
    if total:
        tokens = np.bincount(window % v, count, v)
        p["bias"] = np.log((tokens + 1) / (tokens.sum() + v)).astype(np.float32)
        context, at = np.unique(window // v, return_inverse=True)
        left, right = context // v, context % v
        target = np.zeros((len(context), v), np.float32)
        target[at, window % v] = count / total
        mass = target.sum(1, keepdims=True)
        grid = np.zeros((v * v, width), np.float32)
        m = {k: np.zeros_like(x) for k, x in p.items()}
        s = {k: np.zeros_like(x) for k, x in p.items()}
        for t in range(1, steps + 1):
            h = np.tanh(p["left"][left] + p["right"][right])
            z = h @ p["output"] + p["bias"]
            z -= z.max(1, keepdims=True)
            np.exp(z, out=z)
            z *= mass / z.sum(1, keepdims=True)
            z -= target
            back = (z @ p["output"].T) * (1 - h * h)
            grid[context] = back
            g = {"output": h.T @ z, "bias": z.sum(0), "left": grid.reshape(v, v, width).sum(1),
                 "right": grid.reshape(v, v, width).sum(0)}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k] * g[k]
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-10)
    return WindowNetwork(vocabulary, **p)


def fit_network(docs: DataFrame, top_words: int = TOP_WORDS, buckets: int = BUCKETS, text_col: str = "text",
                **options) -> WindowNetwork:
    """The network of all whole texts of ``docs``."""
    text = docs.select(F.col(text_col).alias("text"))
    counts = stored(text.mapInArrow(_word_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "h").limit(top_words).select("h").toArrow()
    vocabulary = Vocabulary(np.sort(top["h"].to_numpy().view(np.uint64)), buckets)
    got = (text.mapInArrow(_window_counts(vocabulary), "w int, n long")
           .groupBy("w").agg(F.sum("n").alias("n")).toArrow())   # at most size ** 3 rows
    window, count = got["w"].to_numpy().astype(np.int64), got["n"].to_numpy()
    order = np.argsort(window)
    network = train(vocabulary, window[order], count[order], **options)
    network.counts, network.mass = counts, np.ones(vocabulary.size)
    per_class = counts.mapInArrow(_class_mass(vocabulary), "c int, m long").groupBy("c").agg(F.sum("m").alias("m"))
    for r in per_class.collect():                                 # a row a class
        network.mass[r["c"]] += r["m"]
    return network


def _class_mass(vocabulary: Vocabulary):
    def run(batches):
        mass = np.zeros(vocabulary.size, np.int64)
        for b in batches:
            np.add.at(mass, vocabulary.ids(b.column(0).to_numpy().view(np.uint64)), b.column(1).to_numpy() + 1)
        yield pa.record_batch([pa.array(np.arange(len(mass), dtype=np.int32)), pa.array(mass)], names=["c", "m"])
    return run


def _scores(model):
    """Rows (doc_id, t, k, word, f, value): a document's tokens and sum, and its words that are not broadcast.

    t stands for the text and k is what the row is joined by: a word's hash, or nothing for the document's own row.
    """
    def run(batches):
        network, hot, hot_n = model.value
        table, v = network.log_table(), network.vocabulary.size
        listed = 1 + len(network.vocabulary.words)
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                w, left, token, right = network.vocabulary.windows(data, off)
                value = table[(left.astype(np.int64) * v + right) * v + token].astype(np.float64)
                rare = np.zeros(0, np.int64)
                if network.mass is not None:
                    others = np.flatnonzero(token >= listed)
                    h = w.hash[others]
                    value[others] -= np.log(network.mass[token[others]])
                    known = np.zeros(len(h), bool)
                    if len(hot):
                        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                        known = hot[at] == h
                        value[others[known]] += np.log(hot_n[at[known]] + 1.0)
                    rare = others[~known]
                total = np.concatenate(([0.0], np.cumsum(value)))
                order = rare[np.lexsort((w.hash[rare], w.doc[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
                first = np.flatnonzero(new)
                words, freq = order[first], np.diff(np.append(first, len(order)))
                t = span_hashes(data, off[:-1], off[1:])
                n = hi - lo
                row = np.concatenate((np.arange(n), w.doc[words]))
                spread = mix(t + np.arange(n, dtype=np.uint64))   # these keys meet no word; they only spread the rows
                yield pa.record_batch(
                    [b.column(0).slice(lo, n).take(pa.array(row)), pa.array(signed(t)[row]),
                     pa.array(signed(np.concatenate((spread, w.hash[words])))), pa.array(np.arange(len(row)) >= n),
                     pa.array(np.concatenate((w.n_words, freq)).astype(np.int64)),
                     pa.array(np.concatenate((total[w.first[1:]] - total[w.first[:-1]], np.zeros(len(words)))))],
                    names=["doc_id", "t", "k", "word", "f", "value"])
    return run


def score_documents(docs: DataFrame, network: WindowNetwork | None = None, hot: int = HOT, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """Per row: n_tokens, log_likelihood (sum over tokens) and per_token (its mean).

    Without a ``network``, one is trained on ``docs``.  Null and empty texts have no tokens,
    log-likelihood 0 and a null mean; a text of one token is predicted from its two edges.
    Equal texts score alike and rows that repeat give one row each; other columns are ignored;
    an empty table gives an empty result.  ``hot`` changes how words are looked up, not the scores.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    network = network or fit_network(own, **options)
    counts = network.counts
    words, n = np.zeros(0, np.uint64), np.zeros(0)
    if counts is not None:
        top = most_frequent(counts.withColumnRenamed("n", "c"), hot).orderBy("h").toArrow()
        words, n = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
        order = np.argsort(words)
        words, n = words[order], n[order]
    plain = WindowNetwork(network.vocabulary, network.left, network.right, network.output, network.bias, None, network.mass)
    model = own.sparkSession.sparkContext.broadcast((plain, words, n))
    kind = dict(own.dtypes)["doc_id"]
    rows = own.mapInArrow(_scores(model), f"doc_id {kind}, t long, k long, word boolean, f long, value double")
    part = F.col("value")
    if counts is not None:
        rows = rows.join(counts.select(F.col("h").alias("k"), "n"), "k", "left")
        part = part + F.when(F.col("word"), F.col("f") * F.log(F.coalesce("n", F.lit(0)) + 1)).otherwise(0.0)
    sums = rows.groupBy("doc_id", "t").agg(F.count_if(~F.col("word")).alias("m"), F.sum(F.when(~F.col("word"), F.col("f"))).alias("f"),
                                           F.sum(part).alias("s"))
    # m rows had this id and text: each has an equal share of the sums
    each = sums.select("doc_id", F.expr("f div m").alias("n_tokens"), (F.col("s") / F.col("m")).alias("log_likelihood"),
                       F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("_i")).drop("_i")
    return each.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
