"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from attrix.llm.chat import conversation_digests, format_conversations
from attrix.llm.common import table
from attrix.llm.decontaminate import find_contamination
from attrix.llm.filter_audit import audit_filters
from attrix.llm.lines import dedup_lines
from attrix.llm.lm_scoring import score_documents
from attrix.llm.mixing import mix_rates
from attrix.llm.near_duplicates import near_duplicates
from attrix.llm.quality import STATS, score_quality
from attrix.llm.spelling import spelling_variants
from attrix.llm.substrings import dedup_substrings
from attrix.llm.tokens import count_tokens
from attrix.llm.toxicity import score_toxicity
from attrix.llm.warc import round_trip


def op1_lm_scoring(spark, sf_dir):
    """Masked pseudo-likelihood of every document under a network trained on all of them."""
    return score_documents(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark, sf_dir):
    """All documents mixed to source weights 1, 2, 3 (repeating) of the whole corpus."""
    return mix_rates(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_quality_rules(spark, sf_dir):
    """Base rules and perplexity bands over all documents, under models of byte classes and of all code points."""
    return score_quality(table(spark, sf_dir, "documents"), code_points=True).select(
        "doc_id", *STATS, "base_failed", "kept", "perplexity", "char_perplexity")


def op4_substring_dedup(spark, sf_dir):
    """Words of every 20-word run that starts earlier are removed; digest of what is kept."""
    return dedup_substrings(table(spark, sf_dir, "documents"), texts=False)


def op5_warc(spark, sf_dir):
    """Every page written to Zstandard WARC archives and read back."""
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_line_dedup(spark, sf_dir):
    """Lines of all documents that repeat an earlier line, exactly or within one edit."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed_lines"))


def op7_token_counts(spark, sf_dir):
    """Tokens of every document under the word-end BPE vocabulary."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the labels that are not held out."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_benchmark_decontamination(spark, sf_dir):
    """Every document against every benchmark item: 13-word windows found by winnowing."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_near_duplicates(spark, sf_dir):
    """Near-duplicate groups of all documents: five-word shingles, similarity 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark, sf_dir):
    """Every order of five filters over all documents, per language."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark, sf_dir):
    """Words of all documents with their near words, forms and roots."""
    return spelling_variants(table(spark, sf_dir, "documents"))


# Fixed by the query's contract: a conversation whose texts are control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op13_chat_formatting(spark, sf_dir):
    """All conversations as one prefix tree, written and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    return conversation_digests(*format_conversations(turns.unionByName(extra)))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_rules": op3_quality_rules,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_formatting": op13_chat_formatting,
}

SQL = {}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

SQL["op2_mix_sources"] = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len({_WORDS}), 0)::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w
  FROM sized GROUP BY source),
-- a source is at its bound if its words per weight are among the smallest: add them in that order
o AS (
  SELECT *, sum(3 * source_size) OVER k AS held, sum(w) OVER k AS held_w,
         sum(source_size) OVER () AS t, sum(w) OVER () AS all_w
  FROM s WINDOW k AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
b AS (
  SELECT coalesce(max(held) FILTER (bound), 0) AS held, coalesce(max(held_w) FILTER (bound), 0) AS held_w
  FROM (SELECT *, 3 * source_size * (all_w - held_w + w) <= w * (t - held + 3 * source_size) AS bound FROM o)),
tgt AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size * (all_w - b.held_w) <= w * (t - b.held) THEN (3 * source_size)::DOUBLE
              ELSE (w * (t - b.held))::DOUBLE / (all_w - b.held_w)::DOUBLE END AS target
  FROM o, b),
r AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN tgt ON sized.source IS NOT DISTINCT FROM tgt.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN
         ('0x' || md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT / 4503599627370496.0
         < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r
"""

SQL["op4_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
win AS (
  SELECT doc_id, s, sha256(array_to_string(ws[s:s + 19], ' ')) AS k
  FROM d, unnest(generate_series(1, len(ws) - 19)) AS g(s) WHERE len(ws) >= 20),
later AS (
  SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
hit AS (SELECT DISTINCT doc_id, s + o AS p FROM later, unnest(generate_series(0, 19)) AS t(o)),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t
  FROM w ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


SQL["op9_benchmark_decontamination"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[s:s + least(13, len(ws)) - 1], ' ') AS k
  FROM b, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS g(s) WHERE len(ws) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM d, ns, unnest(generate_series(1, len(ws) - n + 1)) AS g(s) WHERE len(ws) >= n),
m AS (SELECT doc_id, s, n, item_id FROM dw JOIN bw USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT s + o)::BIGINT AS n_hit FROM m, unnest(generate_series(0, n - 1)) AS t(o) GROUP BY doc_id),
it AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(i, ',' ORDER BY i) AS l
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM m) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

SQL["op10_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS k
  FROM d, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS g(s) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM sh GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS other FROM d UNION SELECT r.node, e.b FROM reach r JOIN e ON e.a = r.other),
c AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""

SQL["op5_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
         FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h)
"""

# within one edit: equal after one character is dropped from the longer line, or, at equal
# length, after the character at the same place is dropped from both
SQL["op6_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln
  FROM documents),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT line, min({'d': doc_id, 'n': ln}) AS first FROM w GROUP BY line),
n AS (SELECT line, first, length(line) AS m FROM f WHERE length(line) >= 20),
v AS (SELECT line, first, m, i, md5(left(line, i - 1) || substr(line, i + 1)) AS k FROM n, unnest(generate_series(1, m)) AS t(i)),
p AS (
  SELECT a.line, b.first FROM v a JOIN v b ON a.k = b.k AND a.i = b.i AND a.m = b.m AND a.line <> b.line
  UNION ALL SELECT a.line, b.first FROM v a JOIN n b ON a.k = md5(b.line) AND b.m = a.m - 1
  UNION ALL SELECT b.line, a.first FROM v a JOIN n b ON a.k = md5(b.line) AND b.m = a.m - 1),
e AS (SELECT line, min(first) AS first FROM (SELECT * FROM p UNION ALL SELECT * FROM f) GROUP BY line),
g AS (SELECT doc_id, string_agg(ln::VARCHAR, ',' ORDER BY ln) AS r, count(*)::BIGINT AS c
      FROM w JOIN e USING (line) WHERE {'d': doc_id, 'n': ln} > first GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(c, 0)::BIGINT AS n_removed,
       coalesce(r, '') AS removed_lines
FROM documents LEFT JOIN g USING (doc_id)
"""

SQL["op11_filter_audit"] = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS} AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
m AS (
  SELECT part, doc_id, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
         regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails FROM w),
lab AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
n AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m LEFT JOIN lab USING (doc_id) GROUP BY part, fails),
l AS (SELECT unnest(range(1, 6)) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, step, o[step] AS f, list_aggregate([substr('ABCDE', x, 1) FOR x IN o], 'string_agg', '') AS filter_order
      FROM o, range(1, 6) AS g(step)),
x AS (
  SELECT part, filter_order, step::INTEGER AS step, f, n, good, toxic, fails[f] AS hit,
         len([y FOR y IN o[1:step - 1] IF fails[y]]) > 0 AS gone, len([y FOR y IN fails IF y]) = 1 AS single
  FROM n, s),
r AS (
  SELECT part, filter_order, step, any_value(f) AS f,
         coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND hit), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND hit), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (hit AND single), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND hit), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND hit), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY part, filter_order, step)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM r
"""

# crc32 byte by byte with the usual table of the reversed polynomial, built by its rule
SQL["op12_spelling_variants"] = r"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) AS g(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY doc_id, w),
h AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(x, 2 * i + 1, 2))::BIGINT FOR i IN range(len(x) // 2)]),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || w)) AS x FROM c), tab),
v AS (
  SELECT w AS word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w, n FROM h)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
del AS (SELECT word, n, length(word) AS m, i, left(word, i - 1) || substr(word, i + 1) AS k FROM v, unnest(generate_series(1, length(word))) AS t(i)),
e AS (
  SELECT a.word, b.word AS near, b.n FROM del a JOIN del b ON a.k = b.k AND a.i = b.i AND a.m = b.m AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM del a JOIN v b ON a.k = b.word
  UNION SELECT b.word, a.word, a.n FROM del a JOIN v b ON a.k = b.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, min({'o': -n, 'w': near}) AS b FROM e GROUP BY word),
f AS (
  SELECT word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.o >= 2 * v.n THEN b.w END AS form, CASE WHEN -b.o >= 2 * v.n THEN (-b.o)::BIGINT END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS d FROM f
  UNION ALL SELECT chain.word, f.form, d + 1 FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
r AS (SELECT word, arg_max(root, d) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN r USING (word)
"""

SQL["op13_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
f AS (
  SELECT *, length(regexp_replace(text, '(\\|</?s>|\[/?(INST|SYS|ROLE)\])', '\\\1', 'g'))
    + CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'system' THEN length('[SYS]  [/SYS]') WHEN 'assistant' THEN length(' </s>')
           ELSE length('[ROLE]  [/ROLE] </s>') + length(regexp_replace(role, '(\\|</?s>|\[/?(INST|SYS|ROLE)\])', '\\\1', 'g')) END AS n
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(n) + length('<s>'))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
