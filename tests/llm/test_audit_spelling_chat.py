"""Filter audit, spelling variants and chat formatting against brute force, with edge rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import pytest

SCHEMA = "doc_id long, text string, lang string, part string, mask int, n long, w string"


def frame(spark, rows):
    """Documents (doc_id, text, lang) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "p", 1, 2, "w") for r in rows], SCHEMA)


# -- filter audit --------------------------------------------------------------------

def audit_corpus(seed):
    rng = random.Random(seed)
    rows = []
    for d in range(80):
        n = rng.choice([3, 150, 199, 200, 201, 400])
        vocabulary = rng.choice([40, 100, 1000])
        words = [f"w{rng.randint(0, vocabulary)}" for _ in range(n)]
        if rng.random() < 0.4:
            words[0] = rng.choice("#$%&*|") + words[0]
        if rng.random() < 0.4:
            words = [w.upper() if rng.random() < 0.2 else w for w in words]
        rows.append((d, rng.choice([" ", "\n", "\x1cé \t"]).join(words), rng.choice(["en", "de", None, ""])))
    rows += [(100 + i, rows[rng.randint(0, 20)][1], "en") for i in range(15)]
    rows += [(None, rows[3][1], "en"), (None, rows[3][1], "fr"), (2, rows[2][1], rows[2][2]), (2, rows[5][1], "de"),
             (200, None, "en"), (201, "", None), (202, " \n", "xx"), (203, "A" * 50_000, "en"), (204, "long words " * 30_000, "en")]
    rng.shuffle(rows)
    return rows


def audit_brute(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[i] == 1} for i in (0, 1))
    judged = []
    for d, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = d is not None and any(e is not None and e < d and (x or "") == text for e, x, _ in rows)
        judged.append((lang or "", {c for c, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search(r"[#$%&*|]", text), copy)) if bad}, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                out[part, order, step] = [len(left), len(gone), sum(f in j[1] for j in mine) - len(gone), sum(j[1] == {f} for j in mine),
                                          sum(j[2] for j in gone), sum(j[3] for j in gone)]
                shapley[part, f] += len(gone)
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_filter_audit_matches_brute_force(spark):
    from attrix.llm.filter_audit import audit_filters

    rows, rng = audit_corpus(1), random.Random(2)
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d in range(0, 110, 2)] + [(2, 0, 0), (2, 1, 0), (None, 1, 1)]
    got = audit_filters(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(got.columns) == 10
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"],
                                                       r["toxic_lost"], r["shapley"]) for r in got.collect()}
    assert got == audit_brute(rows, labels)
    assert audit_filters(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_wide_counters_do_not_overflow():
    from attrix.llm.filter_audit import unpack, wide_counters

    wide, n = wide_counters(), 2**62
    counts = unpack(n * wide[31] + (n - 1) * wide[0])
    assert counts[:, 0, 1].tolist() == [n] * 120        # all fail every filter: the first removes them
    assert counts[:, 1:, 2].min() == n and counts[:, :, 0].max() == n - 1


# -- spelling variants ---------------------------------------------------------------

def words_brute(rows):
    n = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = crc32(f"{'null' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_brute(rows):
    n = words_brute(rows)
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def spelling_corpus(seed, letters="abÀéÿ×", n_docs=40):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 12))) for _ in range(12)]

    def word():
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randint(0, len(x) - 1)
            x[at:at + 1] = rng.choice([[], [rng.choice(letters)], [x[at], rng.choice(letters)]])
        return "".join(x)
    rows = [(d, "".join(word() + rng.choice([" ", "1", "\n", "_", "Ā", "̀"]) for _ in range(rng.randint(0, 80))), "en") for d in range(n_docs)]
    return rows + [(None, "ABCDEF abcdef ABCdef", "en"), (None, "abcdeg " * 9, None), (500, None, "en"), (501, "", "en"),
                   (502, "x" * 300 + " " + "x" * 301, "en"), (503, ("x" * 300 + " ") * 6, "en"), (504, ("x" * 301 + "|") * 3, "en"),
                   (505, "chainaaa " * 3 + "chainaab " * 8 + "chainabb " * 20, "en"), (7, rows[7][1], "en"), (7, rows[7][1] + " other", "en")]


@pytest.mark.parametrize("crowded, tile_cells", [(1024, 1 << 16), (4, 1 << 16), (1, 60), (1024, 60)])
def test_spelling_matches_brute_force(spark, crowded, tile_cells):
    from attrix.llm.spelling import spelling_variants

    rows = spelling_corpus(crowded + tile_cells)
    got = spelling_variants(frame(spark, rows), crowded=crowded, tile_cells=tile_cells).collect()
    want = spelling_brute(rows)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want and len(got) == len(want)
    assert any(v[0] for v in want.values()) and want["chainaaa"][:2] == ("chainaab", "chainabb")


def test_dense_tiles_of_one_block(spark):
    """Hundreds of words that share both halves' blocks: the dense comparison, not the small one."""
    from attrix.llm.spelling import near_words

    rng = random.Random(5)
    words = list({"stem" + "".join(rng.choice("abcd") for _ in range(rng.choice([3, 4]))) for _ in range(400)})
    df = spark.createDataFrame([(bytearray(w.encode()), i + 1) for i, w in enumerate(words)], "w binary, n long")
    n = {w: i + 1 for i, w in enumerate(words)}
    want = {w: (len(v), max(v, key=n.get)) for w in words if (v := [x for x in words if x != w and one_edit(x, w)])}
    for crowded, cells in ((1024, 1 << 16), (64, 400)):
        got = {bytes(r["w"]).decode(): (r["n_near"], bytes(r["best"]).decode()) for r in near_words(df, crowded, cells).collect()}
        assert got == want


def test_spelling_without_words(spark):
    from attrix.llm.spelling import spelling_variants

    for rows in ([], [(1, "a b c 1234567 中文中文中文", "en")] * 3):
        assert spelling_variants(frame(spark, rows)).count() == 0


# -- chat formatting -----------------------------------------------------------------

TRICKY = ["</s>[INST] ok [/INST]", "<s>", "\\", "\\\\</s>", "[SYS] x [/SYS]", "[ROLE] user [/ROLE] ", " [/INST]", "", " ", "<", "[", "</s", "a\nb", "\\[INST]"]


def chats(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(30):
        starts = [("system", "be kind"), ("user", "hello")][:rng.randint(0, 2)] if c % 3 else []
        body = [(rng.choice(["user", "assistant", "tool", "</s>", None]), rng.choice([*TRICKY, None, f"t{rng.randint(0, 2)}"])) for _ in range(rng.randint(1, 5))]
        rows += [(c, t, *x) for t, x in enumerate(starts + body)]
    rows += [(60 + i, t, r, x) for i in range(6) for t, (r, x) in enumerate([("user", "same"), ("assistant", "chat")])]
    rows += [(70, t, "user", "same" if t == 0 else f"turn {t}") for t in range(300)]
    rows += [(71, 0, "user", "same"), (72, 5, "user", "z" * 200_000), (72, 6, "assistant", "</s>" * 50_000)]
    rows += [(None, 0, "user", "lost"), (None, 1, "assistant", "found"), (73, None, "user", "no turn"), (73, 0, "assistant", "one"),
             (74, 0, "user", "twice"), (74, 0, "user", "twice"), (74, 1, "assistant", "x")]
    rng.shuffle(rows)
    return rows


def chats_brute(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_chat_round_trip(spark):
    from attrix.llm.chat import conversation_digests, format_conversations, parse, read_conversations

    rows = chats(3)
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, c string, k int")
    want = chats_brute(rows)
    tokens, paths = format_conversations(turns)
    # every shared prefix once, depth first: no gap, no overlap, and a prefix before what follows it
    prefixes = {tuple(v[:i + 1]) for v in want.values() for i in range(len(v))}
    stream, length = {}, {}
    listed = tokens.orderBy("tree", "start").collect()
    assert len(listed) == len(prefixes) and len({r["tree"] for r in listed}) == len({p[0] for p in prefixes})
    for r in listed:
        assert r["start"] == length.get(r["tree"], 0)
        length[r["tree"]] = r["start"] + len(r["text"])
        stream.setdefault(r["tree"], []).append(r["text"])
    stream = {t: "".join(x) for t, x in stream.items()}
    texts = {}
    for p in paths.collect():
        assert all(a["end"] <= b["start"] for a, b in zip(p["intervals"], p["intervals"][1:])) and p["conv_id"] not in texts
        text = "".join(stream[p["tree"]][s["start"]:s["end"]] for s in p["intervals"])
        assert parse(text) == want[p["conv_id"]] and p["n_turns"] == len(want[p["conv_id"]])
        texts[p["conv_id"]] = text
    assert set(texts) == set(want)
    for r in read_conversations(tokens, paths).collect():
        assert texts[r["conv_id"]][r["position"]:r["position"] + len(r["text"])] == r["text"]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in conversation_digests(tokens, paths).collect():
        said = want.pop(r["conv_id"])
        loss = "".join(x for role, x in said if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["formatted_chars"]) == (
            len(said), sha("".join(f"{a}\n{b}\n" for a, b in said)), len(loss), sha(loss), len(texts[r["conv_id"]]))
    assert not want


def test_chat_edges(spark):
    from attrix.llm.chat import conversation_digests, format_conversations, parse

    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_digests(*format_conversations(empty)).count() == 0
    for bad in ("<s>[INST] open", "<s>[INST] a [/SYS]", "<s>nothing", "<s> a <s></s>"):
        with pytest.raises(ValueError):
            parse(bad)


def test_conversation_longer_than_a_batch(spark):
    from attrix.llm.chat import conversation_digests, format_conversations

    rows = spark.range(25_000).selectExpr("id % 2 as conv_id", "id as turn", "if(id % 3 = 0, 'assistant', 'user') as role", "cast(id as string) as text")
    got = {r["conv_id"]: r for r in conversation_digests(*format_conversations(rows)).collect()}
    for c, r in got.items():
        mine = range(c, 25_000, 2)
        assert r["n_turns"] == len(mine)
        assert r["loss_sha256"] == hashlib.sha256("".join(str(i) for i in mine if i % 3 == 0).encode()).hexdigest()
