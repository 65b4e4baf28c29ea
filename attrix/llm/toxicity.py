"""Toxicity classifier with a counterfactual penalty on identity terms.

Features are the presence of words and word prefixes (hashed, A-Z lower-cased).  A
logistic model is fitted on at most ``MAX_ROWS`` labelled texts (those with the smallest
hash of their id).  Of the ``CANDIDATES`` features that tell the labels apart best, those
enter the model, some at a time, that still explain what it gets wrong (a score test),
until none does: features that merely come along with toxic words stay out.
Every labelled text that mentions a group gets a twin in which the term is swapped for
another of its list; the loss adds ``PENALTY`` times the mean squared difference of the
two scores before the logistic function, so a mention by itself cannot carry the label.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from attrix.llm.common import stored
from attrix.llm.words import ALNUM_WORD, byte_totals, find_words, mix, signed, slices, span_hashes

MAX_ROWS = 12_000
CANDIDATES = 8_192
MIN_TEXTS = 5
ENTER, ENTER_AT_ONCE, ROUNDS = 12.0, 16, 60   # score statistic to enter, features a round, rounds
PENALTY = 1.0
RIDGE = 1e-6
THRESHOLD = 0.7
PREFIXES = (3, 4, 5, 6, 7, 8, 9)   # bytes; of longer words only, so a stem is told from its inflections

#: Lists of terms that may stand for one another in a sentence.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "arab", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("deaf", "blind", "disabled"), ("old", "young"), ("american", "mexican", "chinese", "german", "french", "spanish"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "flüchtlinge", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "españoles"),
)


def _features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word index, hash) of each kind of feature: words, and per length the prefixes of longer words."""
    total = byte_totals(data, fold=True)
    out = [(np.arange(len(start)), span_hashes(data, start, end, total=total))]
    for k in PREFIXES:
        i = np.flatnonzero(end - start > k)
        out.append((i, mix(span_hashes(data, start[i], start[i] + k, total=total) + np.uint64(k))))
    return out


def _word_features(word: str) -> np.ndarray:
    data = np.frombuffer(word.encode(), np.uint8)
    return np.concatenate([h for _, h in _features(data, np.array([0]), np.array([len(data)]))])


def _text_features(data, off):
    """Distinct (document, feature) of a slice, sorted."""
    w = find_words(data, off, ALNUM_WORD, fold=True, hashes=False)
    f = _features(data, w.start, w.end)
    doc, h = np.concatenate([w.doc[i] for i, _ in f]), np.concatenate([h for _, h in f])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _label_counts(batches):
    """(label, text) -> texts with each feature, by label, summed within the task."""
    total: dict[int, list] = {0: [], 1: []}
    for b in batches:
        label = b.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, data, off in slices(b.column(1)):
            doc, h = _text_features(data, off)
            for y in (0, 1):
                total[y].append(np.unique(h[label[lo:hi][doc] == y], return_counts=True))
    for y in (0, 1):
        if total[y]:
            h, i = np.unique(np.concatenate([a for a, _ in total[y]]), return_inverse=True)
            n = np.bincount(i, np.concatenate([c for _, c in total[y]]), len(h)).astype(np.int64)
            for k in range(0, len(h), 100_000):
                part = n[k:k + 100_000]
                zero = np.zeros(len(part), np.int64)
                yield pa.record_batch([pa.array(signed(h[k:k + 100_000])), pa.array(part if y else zero),
                                       pa.array(zero if y else part)], names=["f", "toxic", "clean"])


def _examples(chosen: np.ndarray, terms: Sequence[Sequence[str]]):
    """(label, text) -> (label, features among ``chosen``, those of the swapped twin or null)."""
    swap = {}
    for group in terms:
        for i, term in enumerate(group):
            own, other = _word_features(term), _word_features(group[(i + 1) % len(group)])
            swap[int(own[0])] = (own, other)

    def pick(h):
        i = np.minimum(np.searchsorted(chosen, h), len(chosen) - 1)
        return np.unique(i[chosen[i] == h])

    def run(batches):
        keys = np.array(sorted(swap), np.uint64)
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                doc, h = _text_features(data, off)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                own, twin = [], []
                for i in range(hi - lo):
                    mine = h[cut[i]:cut[i + 1]]
                    own.append(pick(mine).astype(np.int32))
                    said = np.intersect1d(mine, keys)
                    if len(said):
                        gone = np.concatenate([swap[int(t)][0] for t in said])
                        new = np.concatenate([swap[int(t)][1] for t in said])
                        twin.append(pick(np.concatenate((np.setdiff1d(mine, gone), new))).astype(np.int32))
                    else:
                        twin.append(None)
                kind = pa.list_(pa.int32())
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(own, kind), pa.array(twin, kind)],
                                      names=["label", "own", "twin"])
    return run


def _rows(lists) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], np.int64)
    return np.repeat(np.arange(len(lists)), n), np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int64)


def fit_logistic(own, twins, label: np.ndarray, n_features: int, penalty: float = PENALTY, ridge: float = RIDGE,
                 steps: int = 250, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias; ``twins`` has the features of each row's swapped twin, or None."""
    cells = [_rows(own)]
    pairs = [i for i, t in enumerate(twins) if t is not None]
    cells += [_rows([own[i] for i in pairs]), _rows([twins[i] for i in pairs])]
    inside = np.zeros(n_features, bool)
    w, bias = np.zeros(n_features), float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    for _ in range(ROUNDS):
        row, col = cells[0]
        p = 1 / (1 + np.exp(-np.bincount(row, w[col], len(label)) - bias))
        spread = np.bincount(col, (p * (1 - p))[row], n_features) + 1e-2
        test = np.where(inside, 0, np.bincount(col, (label - p)[row], n_features) ** 2 / spread)
        best = np.lexsort((np.arange(n_features), -test))[:ENTER_AT_ONCE]
        best = best[test[best] >= ENTER]
        last = not len(best)
        inside[best] = True
        w, bias = _refit([(r[inside[c]], c[inside[c]]) for r, c in cells], label, len(pairs), w, bias, penalty, ridge, 4 * steps if last else steps, rate)
        if last:
            break
    return w, bias


def _refit(cells, label, n_pairs, w, bias, penalty, ridge, steps, rate):
    """Adam on the whole sample, from the weights so far."""
    (row, col), (prow, pcol), (trow, tcol) = cells
    n_features = len(w)
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], len(label)) + bias
        r = (1 / (1 + np.exp(-z)) - label) / len(label)
        g = np.bincount(col, r[row], n_features) + ridge * w
        if n_pairs:
            d = 2 * penalty * (np.bincount(prow, w[pcol], n_pairs) - np.bincount(trow, w[tcol], n_pairs)) / n_pairs
            g += np.bincount(pcol, d[prow], n_features) - np.bincount(tcol, d[trow], n_features)
        g = np.append(g, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


@dataclass
class Classifier:
    feature: np.ndarray   # sorted hashes
    weight: np.ndarray
    bias: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each text of a slice."""
        w = find_words(data, offsets, ALNUM_WORD, fold=True, hashes=False)
        n = len(offsets) - 1
        z = np.full(n, self.bias)
        if len(self.feature):
            maybe = np.zeros(1 << 16, bool)
            maybe[(self.feature & np.uint64(0xFFFF)).astype(np.int64)] = True
            hits = []
            for word, h in _features(data, w.start, w.end):
                at = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
                i = np.minimum(np.searchsorted(self.feature, h[at]), len(self.feature) - 1)
                ok = self.feature[i] == h[at]
                hits.append(w.doc[word[at[ok]]] * len(self.feature) + i[ok])
            hits = np.unique(np.concatenate(hits))
            z += np.bincount(hits // len(self.feature), self.weight[hits % len(self.feature)], n)
        return 1 / (1 + np.exp(-z))


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, candidates: int = CANDIDATES,
        penalty: float = PENALTY, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Classifier:
    """The classifier; docs has doc_id and text, labels has doc_id and toxic (0 or 1).

    Rows without label or id are left out, as are held-out ids; equal texts count once.
    Without rows of both labels every feature has weight 0.
    """
    rows = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = stored(rows, "labelled")
    sample = stored(docs.select("doc_id", "text").where("text is not null").join(rows, "doc_id").select("label", "text")
                    .dropDuplicates(["text"]), "sample")
    counts = (sample.mapInArrow(_label_counts, "f long, toxic long, clean long")
              .groupBy("f").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    n1, n0 = sample.where("label = 1").count(), sample.where("label = 0").count()
    if not n1 or not n0:
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), float(np.log((n1 + 1) / (n0 + 1))))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")

    def part(x, n):  # a term of the G-squared statistic
        e = (a + b) * n / (n1 + n0)
        return F.when(x > 0, x * F.log(x / e)).otherwise(0) + F.when(n - x > 0, (n - x) * F.log((n - x) / (n - e))).otherwise(0)
    best = (counts.where(a + b >= MIN_TEXTS).select("f", (part(a, n1) + part(b, n0)).alias("g"))
            .orderBy(F.desc("g"), "f").limit(candidates).toArrow())
    named = np.concatenate([_word_features(t) for group in terms for t in group] + [np.zeros(0, np.uint64)])
    chosen = np.unique(np.concatenate((best["f"].to_numpy().view(np.uint64), named)))
    got = sample.mapInArrow(_examples(chosen, terms), "label int, own array<int>, twin array<int>").toArrow()
    order = np.lexsort([np.array([len(x) for x in got["own"].to_pylist()]), got["label"].to_numpy()])  # any fixed order does
    own, twin = got["own"].to_pylist(), got["twin"].to_pylist()
    w, bias = fit_logistic([own[i] for i in order], [twin[i] for i in order], got["label"].to_numpy()[order].astype(float),
                           len(chosen), penalty)
    return Classifier(chosen[w != 0], w[w != 0], bias)


def _scores(model):
    def run(batches):
        m = model.value
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(m.score(data, off))], names=["doc_id", "score"])
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", **fit_options) -> DataFrame:
    """Per row: held_out, score (0 to 1) and predicted (1 from ``threshold``).

    The score depends on the text alone; a null or empty text has the score of no features.
    A null id is not held out.  Equal texts have equal scores; other columns are ignored.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    given = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
    model = own.sparkSession.sparkContext.broadcast(fit(own, given, **fit_options))
    kind = dict(own.dtypes)["doc_id"]
    return own.mapInArrow(_scores(model), f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
