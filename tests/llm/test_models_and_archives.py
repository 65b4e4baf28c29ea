"""Language-model scores, the toxicity classifier, WARC archives and the pipeline."""

import io
import math
import random
from collections import Counter

import numpy as np
import pyarrow.fs as pafs
import pytest
import zstandard

SF_SMALL = "/root/testdata/sf0.001"

EDGES = [(None, "a null id"), (90, None), (91, ""), (92, " \t\n"), (93, "same row"), (93, "same row")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, score int, own int, label string")


# -- masked pseudo-likelihood ------------------------------------------------------

def test_network_learns_from_both_sides():
    from attrix.llm.lm_scoring import Vocabulary, train

    # the token is decided by its two neighbours together, by neither alone
    v = Vocabulary(np.arange(1, 6, dtype=np.uint64), 2)
    n = v.size
    window, count = [], []
    for a in (1, 2):
        for b in (1, 2):
            window.append((a * n + b) * n + (3 if a == b else 4))
            count.append(100)
    net = train(v, np.array(window), np.array(count), steps=400)
    table = net.log_table().reshape(n, n, n)
    assert np.allclose(np.exp(table).sum(2), 1, atol=1e-4)
    for a in (1, 2):
        for b in (1, 2):
            assert np.exp(table[a, b, 3 if a == b else 4]) > 0.9


def test_gradient_training_beats_unigrams_on_held_out(spark):
    from attrix.llm.lm_scoring import fit_network, score_documents

    rng = random.Random(1)
    pairs = [("north", "pole"), ("red", "car"), ("big", "house"), ("old", "tree")]
    text = lambda: " ".join(" ".join(rng.choice(pairs)) + " and" for _ in range(60))
    net = fit_network(frame(spark, [(i, text()) for i in range(40)]), top_words=9, buckets=2)
    held = text()
    words = held.split()
    shuffled = " ".join(rng.sample(words, len(words)))
    got = {r["doc_id"]: r for r in score_documents(frame(spark, [(1, held), (2, shuffled), *EDGES]), net).collect() if r["doc_id"]}
    assert got[1]["per_token"] > got[2]["per_token"] + 1
    assert got[1]["n_tokens"] == len(words) and abs(got[1]["per_token"] * len(words) - got[1]["log_likelihood"]) < 1e-6
    table, v = net.log_table(), net.vocabulary
    from attrix.llm.words import ALNUM_WORD, find_words
    data = np.frombuffer(held.encode(), np.uint8)
    ids = [0, *v.ids(find_words(data, np.array([0, len(data)]), ALNUM_WORD, fold=True).hash), 0]
    assert abs(sum(float(table[(ids[i - 1] * v.size + ids[i + 1]) * v.size + ids[i]]) for i in range(1, len(ids) - 1)) - got[1]["log_likelihood"]) < 1e-3
    for d in (90, 91, 92):
        assert got[d]["n_tokens"] == 0 and got[d]["log_likelihood"] == 0 and got[d]["per_token"] is None
    assert score_documents(frame(spark, [])).count() == 0


def test_training_step_goes_down_the_plain_gradient():
    """One step of training against the slope of the loss, summed window by window in plain Python."""
    from attrix.llm.lm_scoring import Vocabulary, WindowNetwork, train

    v = Vocabulary(np.arange(1, 3, dtype=np.uint64), 2)
    n, windows = v.size, {(0, 1, 3): 5, (1, 3, 2): 2, (2, 4, 0): 7, (1, 2, 4): 1, (0, 2, 2): 3}     # left, token, right

    def loss(net):
        total = 0.0
        for (a, t, b), count in windows.items():
            hidden = [math.tanh(float(x) + float(y)) for x, y in zip(net.left[a], net.right[b])]
            z = [sum(h * float(net.output[i][c]) for i, h in enumerate(hidden)) + float(net.bias[c]) for c in range(n)]
            total -= count * (z[t] - math.log(sum(map(math.exp, z))))
        return total / sum(windows.values())

    keys = np.array([(a * n + b) * n + t for a, t, b in windows])
    order = np.argsort(keys)
    arguments = (v, keys[order], np.array(list(windows.values()))[order])
    start, after = (train(*arguments, width=3, steps=k, rate=0.01) for k in (0, 1))
    start.left, start.right, start.output, start.bias = (x.astype(float) for x in (start.left, start.right, start.output, start.bias))
    for name in ("left", "right", "output", "bias"):
        at = getattr(start, name)
        for i in np.ndindex(at.shape):
            old, e = at[i], 1e-4
            at[i] = old + e
            up = loss(start)
            at[i] = old - e
            slope = (up - loss(start)) / (2 * e)
            at[i] = old
            if abs(slope) > 1e-5:       # the first step of Adam is the rate, against the slope's sign
                assert abs(float(getattr(after, name)[i]) - old + 0.01 * math.copysign(1, slope)) < 1e-4


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_scores_equal_a_plain_sum(spark, hot):
    """Every token's class by the network, its share of the class by counts, added up one by one."""
    import re

    from attrix.llm.lm_scoring import fit_network, score_documents
    from attrix.llm.words import ALNUM_WORD, find_words

    rng = random.Random(6)
    words = [f"w{i}" for i in range(25)]
    docs = [(i, " ".join(rng.choices(words, [1 / (1 + j) for j in range(25)], k=rng.randint(0, 30)))) for i in range(25)]
    docs += [(3, docs[4][1]), (None, docs[4][1]), (None, "W1 w1, éa"), (40, docs[4][1]), (40, docs[4][1])]
    net = fit_network(frame(spark, docs), top_words=4, buckets=3, steps=5)
    count, v = Counter(w for _, x in docs for w in re.findall(r"[a-z0-9\u0080-\uffff]+", x.lower())), net.vocabulary
    hashed = lambda w: find_words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]), ALNUM_WORD, fold=True).hash
    cls = {w: int(v.ids(hashed(w))[0]) for w in [*count, "unseen"]}
    mass = Counter()
    for w, c in count.items():
        mass[cls[w]] += c + 1
    table = net.log_table().reshape(v.size, v.size, v.size)

    def score(text):
        w = re.findall(r"[a-z0-9\u0080-\uffff]+", text.lower())
        ids = [0, *[cls[x] for x in w], 0]
        return sum(float(table[ids[i], ids[i + 2], ids[i + 1]])
                   + (math.log((count[x] + 1) / (mass[cls[x]] + 1)) if cls[x] > 4 else 0) for i, x in enumerate(w))
    asked = [*docs, (50, "unseen w1 unseen"), (51, docs[4][1].replace("w9", "w8"))]
    got = score_documents(frame(spark, asked), net, hot=hot).collect()
    want = sorted((i is None, i or 0, score(x)) for i, x in asked)
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["log_likelihood"]) for r in got)
    assert [x[:2] for x in found] == [x[:2] for x in want] and [x[2] for x in found] == pytest.approx([x[2] for x in want], abs=1e-3)
    # words of one bucket are told apart
    one = next(b for b in mass if b > 4 and len({count[w] for w in count if cls[w] == b}) > 1)
    few, many = (f([w for w in count if cls[w] == one], key=count.get) for f in (min, max))
    a, b = (r["log_likelihood"] for r in score_documents(frame(spark, [(1, few), (2, many)]), net, hot=hot).orderBy("doc_id").collect())
    assert a < b


# -- toxicity ----------------------------------------------------------------------

def test_penalty_removes_the_effect_of_a_group_mention():
    from attrix.llm.toxicity import fit_logistic

    # feature 0: an insult; 1 and 2: two groups, the first mentioned mostly in toxic texts; 3: filler
    rng = random.Random(0)
    own, twins, label = [], [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = 1 if rng.random() < (0.9 if toxic else 0.1) else 2
        x = [group, 3] + [0] * (toxic and rng.random() < 0.8)
        own.append(np.array(x))
        twins.append(np.array([3 - group if f in (1, 2) else f for f in x]))
        label.append(float(toxic))
    plain, _ = fit_logistic(own, [None] * 400, np.array(label), 4)
    fair, bias = fit_logistic(own, twins, np.array(label), 4, penalty=5.0)
    assert plain[1] - plain[2] > 2
    assert abs(fair[1] - fair[2]) < 0.3 * (plain[1] - plain[2])
    assert fair[0] + fair[1] + fair[3] + bias > 0


def test_classifier_generalises_and_ignores_held_out_labels(spark):
    from attrix.llm.toxicity import held_out, score_toxicity

    rng = random.Random(5)
    filler = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    insults = ["nastyword", "vileterm", "grimstem"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        w = [rng.choice(filler) for _ in range(30)]
        if toxic:
            w[rng.randint(0, 29)] = rng.choice(insults) + rng.choice(["", "s", "ly", "ness"])
        if i % 9 == 0:
            w[0] = rng.choice(["women", "men"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic), "x"))
    lab = spark.createDataFrame(labels + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    got = {r["doc_id"]: r for r in score_toxicity(frame(spark, rows + EDGES[:5]), lab).collect()}
    wrong = [i for i, t, _ in labels if got[i]["held_out"] and got[i]["predicted"] != t]
    assert sum(got[i]["held_out"] for i, _, _ in labels) > 150 and len(wrong) <= 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    # turning the held-out labels round changes nothing
    turned = lab.withColumn("toxic", __import__("pyspark").sql.functions.expr("if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic)"))
    again = {r["doc_id"]: r["score"] for r in score_toxicity(frame(spark, rows + EDGES[:5]), turned).collect()}
    assert again == {k: r["score"] for k, r in got.items()}
    assert score_toxicity(frame(spark, []), lab).count() == 0
    none = score_toxicity(frame(spark, EDGES), lab.limit(0)).collect()
    assert len(none) == 6 and len({r["score"] for r in none}) == 1


# -- WARC --------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, frame int")


def test_archive_round_trip(spark):
    from attrix.llm.warc import digest, round_trip

    rng = random.Random(2)
    texts = ["<html>" + "".join(rng.choice("abc<>é\r\n") for _ in range(rng.randint(0, 400))) + "</html>" for _ in range(30)]
    rows = [(i, f"http://x/{i}?q=é \r\nWARC-Type: y", rng.choice(texts)) for i in range(80)]
    rows += [(200, None, None), (201, "u", ""), (202, "u", "a" * 2_000_000), (5, "again", rows[5][2]), (None, "u", rows[7][2]), (None, "u", "only here")]
    for least in (0, 100):
        want = []
        for k, _, h in rows:
            data = (h or "").encode()
            ids = [i for i, _, x in rows if (x or "") == (h or "") and i is not None]
            first = min(ids) if ids and len(data) >= least else None
            response = first is None or first == k
            want.append((k or -1, len(data), digest(data), "response" if response else "revisit", -1 if response else first))
        got = [(r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"])
               for r in round_trip(pages(spark, rows), least).collect()]
        want = [(k, *x) if k else (k, *x) for k, *x in want]
        fix = lambda rs: sorted((0 if r[0] == -1 and False else r[0], *r[1:]) for r in rs)
        assert fix(got) == fix(want)
    assert round_trip(pages(spark, [])).count() == 0


def archive(dictionary, records):
    from attrix.llm.warc import dictionary_frame

    z = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    return dictionary_frame(dictionary) + b"".join(z.compress(r) for r in records)


def test_reader_checks_what_it_reads():
    from attrix.llm import warc as w

    good = w._record("response", "<urn:page:1>", "http://a/", w.digest(b"hello"), 5, b"hello")
    again = w._record("revisit", "<urn:page:2>", None, w.digest(b"hello"), 5, b"", "<urn:page:1>")
    samples = [good + bytes([i % 251]) * 50 + str(i).encode() * 30 for i in range(200)]
    dictionary = zstandard.train_dictionary(2048, samples).as_bytes()
    for d in (b"", dictionary, b"raw content dictionary " * 9):
        got = [w.page_of(*x) for x in w.read_archive(io.BytesIO(archive(d, [good, again])))]
        assert [(g["page_id"], g["record_type"], g["refers_to"], g["payload_bytes"]) for g in got] == [("1", "response", None, 5), ("2", "revisit", "1", 5)]
    read = lambda data: [w.page_of(*x) for x in w.read_archive(io.BytesIO(data))]
    whole = archive(dictionary, [good, again])
    broken = [whole[8:], whole[:20], whole[:-3], b"", archive(dictionary, [good + b"x"]), archive(dictionary, [good[:-2]]),
              archive(dictionary, [good.replace(b"WARC/1.1", b"WARC/9.9")]), archive(dictionary, [good.replace(b"hello", b"jello")]),
              archive(dictionary, [good.replace(b"WARC-Date", b"WARC-Dote")]), archive(dictionary, [good.replace(b"Content-Length: 5", b"Content-Length: 6")]),
              w.dictionary_frame(b"") + whole[8 + int.from_bytes(whole[4:8], "little"):]]
    for data in broken:
        with pytest.raises(w.WarcError):
            read(data)


def test_archives_are_plain_files(spark, tmp_path):
    from attrix.llm.warc import read_archive, write_archives

    made = write_archives(pages(spark, [(i, "u", f"page {i}") for i in range(20)]), f"file:{tmp_path}/w").collect()
    found = [f.path for f in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(f"{tmp_path}/w"))]
    assert sorted(found) == sorted("/" + r["path"].removeprefix("file:").lstrip("/") for r in made)
    assert sum(len(list(read_archive(open(f, "rb")))) for f in found) == 20 == sum(r["records"] for r in made)


# -- pipeline ----------------------------------------------------------------------

def test_pipeline_stages_agree_with_their_operators(spark):
    import corpus_pipeline as cp
    from attrix.llm.common import stored, table
    from attrix.llm.decontaminate import find_contamination
    from attrix.llm.mixing import mix_rates
    from attrix.llm.quality import score_quality

    docs = table(spark, SF_SMALL, "documents")
    columns, seen, rows = docs.columns, [], docs
    for name, stage in cp.STAGES:
        before, rows = rows, stored(stage(spark, rows, SF_SMALL), "t")
        seen.append((name, before, rows))
    assert [n for n, _, _ in seen] == ["quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "source_mixing"]
    assert all(out.columns == columns for _, _, out in seen[:-1])
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    (_, a, b), (_, c, d), (_, e, f), (_, g, h), (_, i, j) = seen
    assert ids(b) == ids(score_quality(a).where("kept"))
    from test_lines import brute as brute_lines
    gone = brute_lines([(r["doc_id"], r["text"]) for r in c.collect()], 1, 20)
    want = {r["doc_id"]: "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in set(gone.get(r["doc_id"], []))) for r in c.collect()}
    assert {r["doc_id"]: r["text"] for r in d.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in d.collect() if r["doc_id"] in gone)
    from test_near_duplicates import brute
    comp = brute([(r["doc_id"], r["text"]) for r in e.collect()])
    assert ids(f) == sorted(k for k, v in comp.items() if k == v)
    assert ids(h) == ids(find_contamination(g, table(spark, SF_SMALL, "benchmark")).where("not contaminated"))
    copies = {r["doc_id"]: r["copies"] for r in mix_rates(i).collect()}
    assert ids(j) == sorted(k for k, n in copies.items() for _ in range(n))
    assert sorted(cp.run(spark, SF_SMALL).collect(), key=str) == sorted(j.collect(), key=str)
