"""Quality rules, and the pipeline's first, fourth and fifth stage, against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

from test_corpus_operators import EDGES, corpus, frame, hits, words_of

SF_SMALL = "/root/testdata/sf0.001"


def symbol(byte):
    c = chr(byte)
    if byte < 0x80 and c.isalpha():
        return ord(c.lower()) - 97
    if c in " \t\n\x0b\x0c\r":
        return 26
    if byte < 0x80 and c.isdigit():
        return 27
    if c in ".,;:!?'\"()-":
        return 28
    return 29 if byte < 0x80 else 31 if byte < 0xC0 else 30


class KneserNey:
    """Modified Kneser-Ney of order 4 in dictionaries, over 32 symbols."""

    def __init__(self, texts):
        counts = Counter(g for t in texts for g in self.grams(t))
        self.levels = []
        for _ in range(4):
            have = Counter(counts.values())
            n = [have[k] for k in (1, 2, 3, 4)]
            d = [0, 0.5, 1.0, 1.5]
            if all(n):
                y = n[0] / (n[0] + 2 * n[1])
                d = [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]
            total, left = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3)]
            self.levels.append((counts, d, total, left))
            counts = Counter(g[1:] for g in counts)   # in how many contexts

    @staticmethod
    def grams(text):
        s = [26] * 3 + [symbol(b) for b in text.encode()]
        return [tuple(s[i:i + 4]) for i in range(len(s) - 3)]

    def p(self, gram, level=0):
        if level == 4:
            return 1 / 32
        counts, d, total, left = self.levels[level]
        below = self.p(gram[1:], level + 1)
        if not total[gram[:-1]]:
            return below
        c = counts[gram]
        return (c - d[min(c, 3)]) / total[gram[:-1]] + left[gram[:-1]] / total[gram[:-1]] * below

    def log_perplexity(self, text):
        seen = Counter(self.grams(text))
        return -sum(n * math.log(self.p(g)) for g, n in seen.items()) / len(text.encode())


def base_failed(text):
    w = words_of(text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 8)}
    return len(w) < 20 or 100 * len(covered) > 30 * len(w)


def brute_quality(rows):
    """(text, lang) -> base_failed, log-perplexity, middle and half width of its band; median of an even number: the lower."""
    texts = {(t, x) for t, x in rows if t}
    median = lambda v: sorted(v)[(len(v) - 1) // 2]
    wide = lambda t: math.sqrt(1 + 2000 / len(t.encode()))
    by = defaultdict(list)
    for t, x in texts:
        by[x].append(t)
    lp = {}
    for x, own in by.items():
        model = KneserNey(own)
        lp |= {(t, x): model.log_perplexity(t) for t in own}
    good = {k: v for k, v in lp.items() if not base_failed(k[0])}
    middle = {x: median([v for (_, y), v in good.items() if y == x]) for x in {y for _, y in good}}
    away = {k: abs(v - middle[k[1]]) / wide(k[0]) for k, v in good.items()}
    common, half = median(list(away.values())), {}
    for x in middle:
        own = [v for (_, y), v in away.items() if y == x]
        half[x] = max(8 * (len(own) * median(own) + 20 * common) / (len(own) + 20), 0.01)
    return {k: (base_failed(k[0]), v, middle.get(k[1]), half.get(k[1], 0) * wide(k[0])) for k, v in lp.items()}


def agrees(want, text, lang, kept, perplexity=None):
    """Whether a row's verdict is the brute force's; bands are medians to 1/10000, so a verdict at an edge is free."""
    if not text:
        return not kept
    failed, lp, middle, half = want[text, lang]
    if perplexity is not None and abs(math.log(perplexity) - lp) > 1e-4:
        return False
    if failed or middle is None:
        return not kept
    return abs(abs(lp - middle) - half) < 5e-3 or kept == (abs(lp - middle) <= half)


def test_quality_rules_match_brute_force(spark):
    from attrix.llm.quality import score_quality

    rng = random.Random(12)
    rows = corpus(3, 60, 30) + EDGES + [(500 + i, " ".join(rng.choice(["élan", "ça", "où", "le 3", "(mot)"]) for _ in range(60 + i)), "fr", "s") for i in range(9)]
    rows += [(700 + i, rows[4][1], rows[4][2], "s") for i in range(30)] + [(800, "qxz#~ " * 3 + " ".join(rng.choice("QXZJ") * 7 for _ in range(90)), "en", "s")]
    want = brute_quality([(t, x) for _, t, x, _ in rows])
    text = {d: (t, x) for d, t, x, _ in rows}
    got = score_quality(frame(spark, rows)).collect()
    assert len(got) == len(rows) and any(r["kept"] for r in got) and not next(r for r in got if r["doc_id"] == 800)["kept"]
    assert [r["doc_id"] for r in got if not agrees(want, *text[r["doc_id"]], r["kept"], r["perplexity"])] == []


def plain_mix(rows):
    """(doc_id, source, text) -> copies of each id: weights 1, 2, 3 in turn, at most three times a source's size."""
    size = Counter()
    for _, s, t in rows:
        size[s] += len(words_of(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        rest = sum(size.values()) - sum(target.values())
        full = {s for s in free if 3 * size[s] * sum(weight[k] for k in free) <= weight[s] * rest}
        if not full:
            break
        target |= {s: 3 * size[s] for s in full}
        free -= full
    target |= {s: Fraction(weight[s] * rest, sum(weight[k] for k in free)) for s in free}
    out = Counter()
    for d, s, _ in rows:
        rate = float(target[s]) / size[s] if size[s] else 0.0
        chance = int(hashlib.md5(f"mix-1:{d}".encode()).hexdigest()[:13], 16) / 2 ** 52
        out[d] += math.floor(rate) + (chance < rate - math.floor(rate))
    return +out


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline as cp
    from attrix.llm.common import stored, table

    stages = dict(cp.STAGES)
    docs = table(spark, SF_SMALL, "documents")
    rows = docs.collect()
    want = brute_quality([(r["text"], r["lang"]) for r in rows])
    kept = {r["doc_id"] for r in stages["quality_rules"](spark, docs, SF_SMALL).collect()}
    assert 0 < len(kept) < len(rows)
    assert [r["doc_id"] for r in rows if not agrees(want, r["text"], r["lang"], r["doc_id"] in kept)] == []

    bench = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    some = stored(docs.where("doc_id % 4 = 0"), "some")
    clean = set()
    for r in some.collect():
        n, h, _ = hits(r["text"], bench, 13)
        if not (h > 0 and 20 * h >= n):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in stages["benchmark_decontamination"](spark, some, SF_SMALL).collect()} == clean

    got = Counter(r["doc_id"] for r in stages["source_mixing"](spark, docs, SF_SMALL).collect())
    assert got == plain_mix([(r["doc_id"], r["source"], r["text"]) for r in rows])
