"""Rows without an id, and ids with several texts: each row is judged by its own text, in any row order."""

import hashlib
import random
import re

import pytest

SCHEMA = "doc_id long, text string, removed string, _d int, d int, row string, t1 long, n_chars int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, x, "r", 1, 2, "w", 3, -1) for i, x in rows], SCHEMA)


def in_order(spark, rows):
    """The distinct (id, text) of ``rows`` as the operators order them: by id, nulls first, then by text hash."""
    from attrix.llm.common import document_key

    df = spark.createDataFrame([(i, x) for i, x in dict.fromkeys(rows)], "doc_id long, text string")
    return [(r["doc_id"], r["text"]) for r in df.orderBy(document_key()).collect()]


def texts(seed):
    rng = random.Random(seed)
    shared = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(45)) for _ in range(3)]
    lines = ["this line stands in several texts", "and so does this other line here", "a third line that comes back often"]
    rows = []
    for i in range(24):
        own = [" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 40)))]
        body = own + rng.sample(lines, rng.randint(0, 2)) + rng.sample(shared, rng.randint(0, 2))
        rng.shuffle(body)
        rows.append((rng.choice([None, None, 1, 2, 3, 4]), "\n".join(body)))
    rows += [rows[0], rows[5], (None, None), (None, ""), (2, None), (2, "short"), (2, " ".join(f"x{i}" for i in range(110)))]
    return rows


@pytest.fixture(params=[False, True], ids=["as given", "turned around"])
def rows(request):
    found = texts(11)
    return found[::-1] if request.param else found


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substrings_by_row(spark, rows):
    from attrix.llm.substrings import dedup_substrings

    seen, want = set(), {}
    for doc in in_order(spark, rows):
        w, gone = words(doc[1]), set()
        for s in range(len(w) - 19):
            run = tuple(w[s:s + 20])
            if run in seen:
                gone |= set(range(s, s + 20))
            seen.add(run)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[doc] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in dedup_substrings(frame(spark, rows), texts=False).collect()]
    assert sorted(got, key=str) == sorted([(r[0], *want[r]) for r in rows], key=str)
    assert any(v[1] for v in want.values())


def test_lines_by_row(spark, rows):
    from attrix.llm.lines import dedup_lines, remove_lines

    seen, want = set(), {}
    for doc in in_order(spark, rows):
        lines = [] if doc[1] is None else doc[1].split("\n")
        gone = []
        for n, line in enumerate(lines):
            if line.strip(" \t\n\r\x0b\x0c"):
                if line in seen:
                    gone.append(n)
                seen.add(line)
        want[doc] = (gone, None if doc[1] is None else "\n".join(x for n, x in enumerate(lines) if n not in gone))
    got = [(r["doc_id"], r["removed"]) for r in dedup_lines(frame(spark, rows), max_edits=0).collect()]
    assert sorted(got, key=str) == sorted([(r[0], want[r][0]) for r in rows], key=str)
    out = remove_lines(frame(spark, rows), max_edits=0)
    assert out.columns == frame(spark, rows).columns
    got = [(r["doc_id"], r["text"], r["removed"], r["_d"], r["d"], r["row"], r["t1"], r["n_chars"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(r[0], want[r][1], "r", 1, 2, "w", 3, len(want[r][1]) if want[r][0] else -1) for r in rows], key=str)


def test_lines_lose_nothing_that_is_unique(spark):
    """One line that two texts share goes once; what stands in one text only stays, whatever the ids."""
    from attrix.llm.lines import remove_lines

    shared = "a line that both of them hold"
    for ids in ((None, None), (5, 5), (1, 5)):
        rows = [(ids[0], f"{shared}\nonly here, keep this one"), (ids[1], f"another text that is unique\n{shared}"), (ids[1], "a unique text")]
        for turned in (rows, rows[::-1]):
            kept = "\n".join(r["text"] for r in remove_lines(frame(spark, turned)).collect())
            assert kept.count(shared) == 1
            assert all(x in kept for x in ("only here, keep this one", "another text that is unique", "a unique text"))


def test_contamination_by_row(spark, rows):
    from attrix.llm.decontaminate import find_contamination, remove_contaminated

    find = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (x or "").translate({c: c + 32 for c in range(65, 91)}))
    items = [(0, " ".join(words(texts(11)[3][1])[:30])), (1, " ".join(f"x{i}" for i in range(60))), (2, "Short"), (None, "w1 w2"), (3, None)]
    windows = {}
    for i, x in items:
        w = find(x)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(i)
    want = {}
    for doc in rows:
        w, hit, found = find(doc[1]), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        want[doc] = (len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(w))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in find_contamination(frame(spark, rows), bench).collect()]
    assert sorted(got, key=str) == sorted([(r[0], *want[r]) for r in rows], key=str)
    left = remove_contaminated(frame(spark, rows), bench)
    assert left.columns == frame(spark, rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([r for r in rows if not want[r][3]], key=str)
    assert 0 < left.count() < len(rows)
