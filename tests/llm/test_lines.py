"""Line de-duplication against brute force."""

import random

import pytest

from attrix.llm.lines import dedup_lines, remove_lines

ALPHABET = "abcé中"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, k, min_chars):
    """rows: (doc_id, text) -> {doc_id: removed line numbers}."""
    lines = [(d, i, x) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if x.strip(" \t\n\r\x0b\x0c")]
    lines.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    out = {}
    for i, (d, n, x) in enumerate(lines):
        for e, m, y in lines[:i]:
            if (e, m) != (d, n) and (x == y or (min(len(x), len(y)) >= min_chars and abs(len(x) - len(y)) <= k and distance(x, y) <= k)):
                out.setdefault(d, set()).add(n)
                break
    return {d: sorted(v) for d, v in out.items()}


def corpus(seed, n_docs=30):
    rng = random.Random(seed)
    base = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(4, 24))) for _ in range(12)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randint(0, len(x))
            op = rng.randint(0, 2)
            if op == 0:
                x.insert(at, rng.choice(ALPHABET))
            elif x and at < len(x):
                x[at:at + 1] = [] if op == 1 else [rng.choice(ALPHABET)]
        return "".join(x)
    return [(i, "\n".join(line() if rng.random() > 0.1 else rng.choice(["", " \t"]) for _ in range(rng.randint(0, 6)))) for i in range(n_docs)]


@pytest.mark.parametrize("k, min_chars, crowded", [(1, 5, 64), (1, 5, 1), (2, 6, 64), (2, 6, 1), (3, 6, 1), (0, 5, 64)])
def test_lines_match_brute_force(spark, k, min_chars, crowded):
    from attrix.llm.lines import duplicate_lines

    rows = corpus(k * 10 + min_chars)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in duplicate_lines(df, k, min_chars, crowded).collect():
        got.setdefault(r["doc_id"], []).append(r["ln"])
    assert {d: sorted(v) for d, v in got.items()} == brute(rows, k, min_chars)


def test_long_lines(spark):
    a = "long line " * 3000
    rows = [(1, a + "x"), (2, a + "y"), (3, a[:700] + a[701:] + "x"), (4, a[:700] + a[702:] + "xy")]
    got = {r["doc_id"]: r["removed"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0], 3: [0], 4: []}


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "same line\n\n\nsame line", "c"), (3, "same line\n\n\nsame line", "c"),
            (None, "same line\nother", "d"), (4, "\n \n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed string")
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_lines"], r["removed"]) for r in dedup_lines(df).collect())
    assert got == [(False, 0, 2, []), (True, 1, 0, []), (True, 2, 1, []), (True, 3, 4, [0, 3]), (True, 3, 4, [0, 3]), (True, 4, 3, [])]
    kept = sorted((r["doc_id"] or 0, r["text"], r["removed"]) for r in remove_lines(df).where("doc_id is null or doc_id = 3").collect())
    assert kept == [(0, "same line\nother", "d"), (3, "\n", "c"), (3, "\n", "c")]
    assert dedup_lines(df.limit(0)).count() == 0


def test_bad_parameters(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError):
        dedup_lines(df, max_edits=5, min_chars=5)
