"""Mixing, substring de-duplication, decontamination, quality rules and token counts against brute force, with edge rows."""

import hashlib
import random
import re

import pytest

EDGES = [(None, "a null id with some words", "en", None), (90, None, "en", "s1"), (91, "", None, "s2"), (92, " \t\n", "xx", "s1"),
         (93, "same row", "en", "s1"), (93, "same row", "en", "s1")]
SCHEMA = "doc_id long, text string, lang string, source string, size string, n int, seeds int, items string, c int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)


def corpus(seed, n=40, vocabulary=60):
    rng = random.Random(seed)
    passage = [rng.choice("abcdefgh") + str(rng.randint(0, vocabulary)) for _ in range(40)]
    out = []
    for d in range(n):
        words = [rng.choice("ABcd") + str(rng.randint(0, vocabulary)) for _ in range(rng.randint(0, 60))]
        if d % 3 == 0:
            at, cut = rng.randint(0, len(words)), rng.randint(0, 15)
            words[at:at] = passage[cut:cut + rng.randint(10, 40)]
        if d % 7 == 0:
            words += words
        out.append((d, "".join(w + rng.choice([" ", "\n", "  ", "\x1c "]) for w in words), rng.choice(["en", "de"]), f"s{d % 4}"))
    rng.shuffle(out)
    return out


# -- mixing ------------------------------------------------------------------------

def test_targets_are_bounded_and_complete(spark):
    from attrix.llm.mixing import mix, mix_rates

    rows = [(i, "w " * (5 + i % 7), "en", s) for i, s in enumerate(["a"] * 60 + ["b"] * 4 + ["c"] * 9 + [None] * 30)]
    got = mix_rates(frame(spark, rows + EDGES)).collect()
    per = {}
    for r, (_, _, _, source) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows + EDGES, key=lambda r: (r[0] is None, r[0]))):
        per[source] = (r["source_size"], r["target"])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
    total = sum(s for s, _ in per.values())
    assert abs(sum(t for _, t in per.values()) - total) < 1e-6
    weights = dict(zip(["a", "b", "c", "s1", "s2", None], [1, 2, 3, 1, 2, 3]))
    assert all(t <= 3 * s + 1e-9 for s, t in per.values())
    free = [t / weights[k] for k, (s, t) in per.items() if t < 3 * s]
    assert max(free) - min(free) < 1e-6
    again = {(r["doc_id"], r["taken"]) for r in mix_rates(frame(spark, rows + EDGES).repartition(5)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}
    copies = mix(frame(spark, rows + EDGES), copy_col="n").groupBy("doc_id").count().collect()
    want = {}
    for r in got:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    assert {r["doc_id"]: r["count"] for r in copies} == {k: v for k, v in want.items() if v}
    assert mix_rates(frame(spark, [])).count() == 0 == mix(frame(spark, [])).count()


# -- substrings --------------------------------------------------------------------

def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def without_repeats(rows, length):
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words_of(text)
        gone = set()
        for s in range(len(w) - length + 1):
            k = tuple(w[s:s + length])
            if k in seen:
                gone |= set(range(s, s + length))
            seen.add(k)
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("length, seed", [(20, 8), (6, 3)])
def test_substrings_match_brute_force(spark, length, seed):
    from attrix.llm.substrings import dedup_substrings

    rows = corpus(length) + EDGES[:4] + [(95, "one two " * 50, "en", "s")] + [(200 + i, "long text " * 4000 + str(i), "en", "s") for i in range(2)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in dedup_substrings(frame(spark, rows), length, seed).collect()}
    assert got == without_repeats([r[:2] for r in rows], length)
    digest = {r["doc_id"]: r["kept_sha256"] for r in dedup_substrings(frame(spark, rows), length, seed, texts=False).collect()}
    assert digest == {d: hashlib.sha256(t.encode()).hexdigest() for d, (_, _, t) in got.items()}


def test_substrings_repeated_rows_and_empty(spark):
    from attrix.llm.substrings import dedup_substrings

    rows = [(1, "a b c d e f", "en", "s"), (1, "a b c d e f", "en", "s"), (2, "x a b c d e", "en", "s")]
    got = sorted((r["doc_id"], r["text"]) for r in dedup_substrings(frame(spark, rows), 4, 2).collect())
    assert got == [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x")]
    assert dedup_substrings(frame(spark, [])).count() == 0


# -- decontamination ---------------------------------------------------------------

def hits(text, items, length):
    low = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    w, hit, found = low(text), set(), set()
    for item, t in items:
        q = low(t)
        n = min(len(q), length)
        windows = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if n else set()
        for s in range(len(w) - n + 1 if n else 0):
            if tuple(w[s:s + n]) in windows:
                hit |= set(range(s, s + n))
                found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def test_decontamination_matches_brute_force(spark):
    from attrix.llm.decontaminate import find_contamination

    rows = corpus(4, 50) + EDGES
    rng = random.Random(1)
    texts = [t for _, t, _, _ in rows if t and len(t) > 150]
    items = [(i, " - ".join(words_of(rng.choice(texts))[a:a + rng.choice([3, 5, 13, 14, 30])])) for i, a in enumerate([0, 2, 5, 9, 1, 30, 4, 7, 3, 12])]
    items += [(50, None), (51, ""), (52, "?!"), (None, items[2][1]), (0, items[0][1]), (53, "Ünïcode c7")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    got = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in find_contamination(frame(spark, rows), bench).collect())
    want = []
    for d, t, _, _ in rows:
        n, h, found = hits(t, items, 13)
        want.append((d or -1, n, h, found, h > 0 and 20 * h >= n))
    assert got == sorted(want)
    assert find_contamination(frame(spark, rows), bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert find_contamination(frame(spark, []), bench).count() == 0


# -- quality -----------------------------------------------------------------------

def test_base_statistics_match_brute_force(spark):
    from attrix.llm.quality import score_quality

    rows = corpus(8, 60, 9) + EDGES + [(300, "a#b $c\nx\nx\n\nx | é\n" * 9 + "x", "fr", "s"), (301, "ab " * 30000, "es", "s")]
    got = sorted((r["doc_id"] or -1, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                 for r in score_quality(frame(spark, rows)).collect())
    want = []
    for d, t, _, _ in rows:
        w = words_of(t)
        seen, dup = set(), 0
        for x in (t or "").split("\n"):
            if words_of(x):
                dup += x in seen
                seen.add(x)
        grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 1000 else set(grams)
        cov = {j for i, g in enumerate(grams) if g in twice for j in range(i, i + 8)}
        want.append((d or -1, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cov),
                     len(w) < 20 or 100 * len(cov) > 30 * len(w)))
    assert got == sorted(want)
    assert score_quality(frame(spark, [])).count() == 0


def test_model_is_a_distribution_and_backs_off():
    import numpy as np

    from attrix.llm import quality as q

    rng = np.random.default_rng(0)
    text = rng.choice(list(b"abcab cab "), 4000).astype(np.uint8)
    code = q.codes(text, np.array([0, len(text)]))
    seen, n = np.unique(code, return_counts=True)
    m = q.Model.fit(("en",), seen, n)
    for context in (int(seen[0]) >> 5, 0, 12345):
        p = np.exp(m.log_probability(0, (context << 5) + np.arange(32)))
        assert abs(p.sum() - 1) < 1e-4 and (p > 0).all()
    p = np.exp(m.log_probability(1, np.arange(32)))   # a language without texts
    assert np.allclose(p, 1 / 32, atol=1e-6)
    score = m.scorer()
    whole = score(np.zeros(1, np.int64), text, np.array([0, len(text)]))[0]
    assert abs(whole - m.log_probability(0, code).sum()) < 0.05


def test_noise_is_rejected_and_prose_kept(spark):
    from attrix.llm.quality import filter_quality, score_quality

    rng = random.Random(3)
    syllables = ["the", "and", "ing", "tion", "er", "on", "re", "st"]
    prose = [(i, " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(200)) + ".", "en", "s") for i in range(60)]
    noise = [(100 + i, " ".join("".join(rng.choice("qxzjkvw#$%") for _ in range(6)) for _ in range(200)), "en", "s") for i in range(2)]
    df = frame(spark, prose + noise + EDGES)
    kept = {r["doc_id"] for r in score_quality(df).where("kept").collect()}
    assert kept == {d for d, *_ in prose}
    out = filter_quality(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == kept
    assert filter_quality(frame(spark, [])).count() == 0


def test_copies_have_no_weight_in_model_and_bands(spark):
    import numpy as np

    from attrix.llm.quality import filter_quality, fit_model, score_quality

    rng = random.Random(4)
    syllables = ["the", "and", "ing", "tion", "er", "on", "re", "st"]
    text = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(150)) + "."
    prose = [(i, text(), "en", "s") for i in range(40)]
    other = [(100 + i, text(), x, "s") for i, x in enumerate([None] * 16)]
    copies = [(1000 + i, prose[7][1], "en", "s") for i in range(300)]
    same = [(2000 + i, other[0][1], x, "s") for i, x in enumerate([None] * 60)]
    plain, crowded = frame(spark, prose + other + EDGES), frame(spark, prose + other + copies + same + EDGES)
    a, b = fit_model(plain), fit_model(crowded.repartition(7))
    assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("gram_hash", "gram_log", "context_hash", "context_log"))
    judged = lambda df: {r["doc_id"]: (r["kept"], r["perplexity"] and round(r["perplexity"], 6), r["lower"] and round(r["lower"], 6), r["upper"] and round(r["upper"], 6))
                         for r in score_quality(df).collect()}
    few, many = judged(plain), judged(crowded)
    assert {k: many[k] for k in few} == few and all(few[d][0] for d, *_ in prose + other)
    assert all(many[d] == few[7] for d, *_ in copies) and all(many[d] == few[100] for d, *_ in same)
    assert filter_quality(crowded).count() == len(prose + other + copies + same)


def test_every_language_has_its_own_model_and_band(spark):
    from attrix.llm import quality as q

    rng = random.Random(6)
    speech = {"it": "abc de fgh il", "ru": "жда лис мон ука", "ja": "\u306e \u3057\u305f \u3066\u3044 \u3092\u306f"} | {f"l{i}": " ".join(rng.sample("abcdefghijklmnop", 4)) for i in range(20)}

    def text(syllables):
        return " ".join("".join(rng.choice(syllables.split()) for _ in range(rng.randint(1, 3))) for _ in range(150))

    clean = [(1000 * k + i, text(s), x, "s") for k, (x, s) in enumerate(speech.items(), 1) for i in range(200 if x == "it" else 6)]
    # Italian words under another language's name, and the same without a language
    junk = [(90_000 + i, text(speech["it"]), "ru", "s") for i in range(1)]
    rows = clean + junk + EDGES
    rng.shuffle(rows)
    df = frame(spark, rows)
    got = {r["doc_id"]: r for r in q.score_quality(df).collect()}
    assert q.found_languages(df) == tuple(sorted({*speech, "en", "xx"}))
    assert [d for d, *_ in clean if not got[d]["kept"]] == [] and not any(got[d]["kept"] for d, *_ in junk)
    assert len({(got[d]["lower"] / got[d]["upper"], x) for d, _, x, _ in clean if d % 1000 == 0}) == len(speech)
    alone = {r["doc_id"]: r["perplexity"] for r in q.score_quality(frame(spark, [r for r in rows if r[2] == "ja"])).collect()}
    assert all(abs(got[d]["perplexity"] - p) < 1e-4 * p for d, p in alone.items())
    assert {r["doc_id"] for r in q.filter_quality(df).collect()} == {d for d, r in got.items() if r["kept"]}


# -- token counts ------------------------------------------------------------------

@pytest.mark.parametrize("hot", [0, 5, 1 << 18])
def test_token_counts_equal_the_library(spark, hot):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from attrix.llm.tokens import count_tokens

    path = P.path("word_bpe_49k.json")
    rng = random.Random(hot)
    parts = ["don't ", "Ǆ", "ΣΑΣ", "İx", "<|endoftext|>", "<|ENDOFTEXT|>", "\x00nul", "\x00", " 　", "½²", "42", "été", "é", "中文", "!!'s", "👍🏽", "the ", "re", "'RE"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), "en", "s") for i in range(60)]
    rows += EDGES + [(93, "another text", "en", "s"), (400, "w" * 20000 + " " + "the cat " * 5000, "en", "s")]
    lib = Tokenizer.from_file(path)
    want = sorted((d or -1, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for d, t, _, _ in rows)
    got = count_tokens(frame(spark, rows), path, hot=hot).collect()
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert count_tokens(frame(spark, []), path).count() == 0


def test_other_tokenizer_goes_through_the_library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from attrix.llm.tokens import PreTokenizer

    path = P.path("byte_bpe_50k.json")
    lib, cut = Tokenizer.from_file(path), PreTokenizer(path)
    for t in ("Hello  world, it's 2024!\n\n", "été 中文", "", "a<|endoftext|>b"):
        tokens, special = cut(t)
        assert sum(cut.pieces(tokens)) + special == len(lib.encode(t, add_special_tokens=False).ids)
