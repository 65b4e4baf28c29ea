"""The model of all code points against brute force in dictionaries, with scripts that the byte classes cannot tell apart."""

import math
import random
from collections import Counter

import test_pipeline
from test_corpus_operators import EDGES, corpus, frame
from test_pipeline import KneserNey, agrees, base_failed


class CodePoints(KneserNey):
    """Modified Kneser-Ney of order 5 in dictionaries, over the code points seen and one unknown.

    An n-gram or context that only one text has is unseen there.
    """

    def __init__(self, texts):
        counts = Counter(g for t in texts for g in self.grams(t))
        self.levels, self.texts = [], [Counter() for _ in range(6)]   # in how many texts an n-gram or context of each length is
        for t in texts:
            for k in range(1, 6):
                self.texts[k].update({g[-k:] for g in self.grams(t)})
        contexts = [Counter() for _ in range(5)]
        for t in texts:
            for k in range(1, 6):
                contexts[k - 1].update({g[-k:-1] for g in self.grams(t)})
        self.contexts = contexts
        for _ in range(5):
            have = Counter(counts.values())
            n = [have[k] for k in (1, 2, 3, 4)]
            d = [0, 0.5, 1.0, 1.5]
            if all(n):
                y = n[0] / (n[0] + 2 * n[1])
                own = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
                d = [0] + own if min(own) > 0 else d
            total, left = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3)]
            self.levels.append((counts, d, total, left))
            self.known = len(counts)
            counts = Counter(g[1:] for g in counts)   # in how many contexts

    @staticmethod
    def grams(text):
        s = "    " + text
        return [s[i:i + 5] for i in range(len(text))]

    def p(self, gram, held_out=True):
        if not gram:
            return 1 / (self.known + 1)
        counts, d, total, left = self.levels[5 - len(gram)]
        c, h = counts[gram], gram[:-1]
        if held_out and self.texts[len(gram)][gram] == 1:
            return (1 if self.contexts[len(h)][h] == 1 else left[h] / total[h]) * self.p(gram[1:])
        return (c - d[min(c, 3)]) / total[h] + left[h] / total[h] * self.p(gram[1:], False)

    def log_perplexity(self, text):
        return -sum(math.log(self.p(g)) for g in self.grams(text)) / len(text)


def shuffled(rng, words, n=120):
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(2, 4))) for _ in range(n))


def test_code_point_model_matches_brute_force(spark, monkeypatch):
    from attrix.llm.quality import score_quality

    rng = random.Random(12)
    rows = corpus(3, 40, 30) + EDGES
    rows += [(500 + i, shuffled(rng, ["жда", "лис", "мон", "ука", "\U0001f600"]), "ru", "s") for i in range(9)]
    rows += [(600 + i, shuffled(rng, ["の", "した", "てい", "を"]), None, "s") for i in range(9)]
    rows += [(700 + i, rows[4][1], rows[4][2], "s") for i in range(20)]
    rows += [(800, "ав" * 3 + " ".join(rng.choice("абвгд") * 7 for _ in range(90)), "ru", "s")]
    classes = test_pipeline.brute_quality([(t, x) for _, t, x, _ in rows])
    monkeypatch.setattr(test_pipeline, "KneserNey", CodePoints)   # its bands are found as those of the byte classes
    points = test_pipeline.brute_quality([(t, x) for _, t, x, _ in rows])
    text = {d: (t, x) for d, t, x, _ in rows}
    got = score_quality(frame(spark, rows).repartition(5), code_points=True).collect()
    assert len(got) == len(rows) and any(r["kept"] for r in got) and not next(r for r in got if r["doc_id"] == 800)["kept"]
    for r in got:
        t, x = text[r["doc_id"]]
        by_class = r["perplexity"] is not None and r["lower"] is not None and r["lower"] <= r["perplexity"] <= r["upper"]
        by_point = by_class and r["char_lower"] <= r["char_perplexity"] <= r["char_upper"]
        assert r["base_failed"] == base_failed(t or "") and r["kept"] == (by_point and not r["base_failed"])
        assert agrees(classes, t, x, by_class and not r["base_failed"], r["perplexity"])
        assert agrees(points, t, x, r["kept"], r["char_perplexity"]) or not by_class

    # a model in many shards gives what one shard gives
    key = lambda rs: sorted((str(r["doc_id"]), r["kept"], r["char_perplexity"] or 0) for r in rs)
    split = key(score_quality(frame(spark, rows), code_points=True, shard=3000).collect())
    assert len(split) == len(got) and all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-5 * (1 + x[2]) for x, y in zip(split, key(got)))
    assert score_quality(frame(spark, []), code_points=True).count() == 0


def test_op3_tells_noise_from_prose_in_any_script(spark, tmp_path):
    """Every Cyrillic letter is the same pair of byte classes, under which the noise reads like the prose."""
    from attrix.llm.queries import op3_quality_rules

    rng = random.Random(5)
    words = ["жда", "лис", "мон", "ука", "вет", "гор", "дом", "река"]
    letters = [chr(c) for c in range(0x430, 0x450)]
    prose = [(i, shuffled(rng, words, 200), "ru", "s") for i in range(60)]
    # words of the lengths of the prose's, in letters drawn at random
    noise = [(100 + i, "".join(x if x == " " else rng.choice(letters) for x in shuffled(rng, words, 200)), "ru", "s") for i in range(2)]
    frame(spark, prose + noise).write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_quality_rules(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == {d for d, *_ in prose} and len(got) == 62


def test_code_points_of_bytes():
    import numpy as np

    from attrix.llm.char_grams import code_points

    texts = ["", "aé中\U0001f600", "", "z\x00ж", ""]
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    got, first = code_points(np.frombuffer(b"".join(raw), np.uint8), off)
    assert got.tolist() == [ord(c) for t in texts for c in t] and first.tolist() == [0, 0, 4, 4, 7, 7]
    got, first = code_points(np.frombuffer(b"\x80\xff\xbfa", np.uint8), np.array([0, 1, 4]))   # not UTF-8: no text takes from its neighbour
    assert len(got) == 3 and first.tolist() == [0, 1, 3] and got[2] == ord("a")
