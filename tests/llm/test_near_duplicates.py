"""Near-duplicate groups against brute force, on every candidate path."""

import random

import numpy as np

from attrix.llm import near_duplicates as nd
from attrix.llm.components import components, union_find


def shingle_set(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, percent=75):
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    edges = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                edges.append((a, b))
    uf = union_find(edges)
    return {d: uf.get(d, d) for d, _ in sets}


def family(seed, n, words=60, base=None, edits=6):
    """Copies of one text, each edited on its own: many pairs lie just below the threshold."""
    rng = random.Random(seed)
    text = base or [f"w{rng.randint(0, 400)}" for _ in range(words)]
    out = []
    for _ in range(n):
        x = list(text)
        for at in rng.sample(range(len(x)), rng.randint(0, edits)):
            x[at] = f"z{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(x))
    return out


def test_groups_match_brute_force(spark):
    texts = family(1, 40) + family(2, 20, 12, edits=2) + family(3, 30, 200, edits=14)
    texts += ["", None, " \t", "one two", "One TWO", "three", texts[3], texts[3].upper()]
    random.Random(5).shuffle(texts)
    rows = list(enumerate(texts))
    assert sum(i != c for i, c in brute(rows).items()) > 20
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(df).collect()}
    want = brute(rows)
    assert got == {d: (len(shingle_set(t)), want[d], want[d] == d) for d, t in rows}


def test_rare_pairs_miss_no_link(spark):
    """Prefix filtering against all pairs, with sizes apart and every document its own component."""
    rng = random.Random(9)
    sets = []
    for i in range(60):
        base = rng.sample(range(400), rng.randint(3, 120)) if i % 4 == 0 else sets[-1]
        keep = [x for x in base if rng.random() > 0.08]
        sets.append(keep + [1000 + rng.randint(0, 10 ** 6) for _ in range(rng.randint(0, 1 + len(base) // 10))] or [1])
    sets = [set(x) for x in sets]
    table = spark.createDataFrame([(i, bytearray(np.array(sorted(x), np.int64).tobytes())) for i, x in enumerate(sets)], "doc_id long, s binary")
    members = spark.createDataFrame([(i, len(x), i) for i, x in enumerate(sets)], "rep long, n long, c long")
    for percent in (75, 50):
        got = {(r["a"], r["b"]) for r in nd._rare_pairs(members, table, percent, "long").collect()}
        want = {(i, j) for j, y in enumerate(sets) for i, x in enumerate(sets[:j]) if 100 * len(x & y) >= percent * len(x | y)}
        assert len(want) > 15 and want <= got
        assert len(got) < 60 * 59 / 4


def test_null_and_repeated_ids(spark):
    a, b = "a b c d e f", "u v w x y z"
    rows = [(None, a), (5, a), (5, b), (7, b), (3, a), (9, None), (9, None)]
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in
                 nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (9, 9, True), (9, 9, True)]
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signature_equals_element_by_element_algorithm():
    rng = np.random.default_rng(3)
    for n in (1, 3, 40, 500):
        h = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        got = nd.super_minhash(np.zeros(len(h), np.int64), h, 1)[0]
        want = np.full(nd.SLOTS, np.iinfo(np.int64).max)
        for x in h:
            perm = list(range(nd.SLOTS))
            for j in range(nd.SLOTS):
                u = int(nd.mix(np.array([x + np.uint64((2 * j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))]))[0])
                k = j + ((u & 0xFFFFFFFF) * (nd.SLOTS - j) >> 32)
                perm[j], perm[k] = perm[k], perm[j]
                want[perm[j]] = min(want[perm[j]], (j << 32) + (u >> 32))
        assert (got == want).all()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sig = [nd.super_minhash(np.zeros(600, np.int64), np.sort(pool[i:i + 600]), 1)[0] for i in (0, 100)]
    assert abs((sig[0] == sig[1]).mean() - 500 / 700) < 0.12


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {n: c for n, c in union_find(edges).items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
