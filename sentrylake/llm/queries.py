"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm.alignment import tokenizer_alignment
from sentrylake.llm.common import table
from sentrylake.llm.html import main_text
from sentrylake.llm.linededup import line_dedup
from sentrylake.llm.lm import lm_scores
from sentrylake.llm.minhash import near_duplicates
from sentrylake.llm.packing import pack_documents
from sentrylake.llm.pieces import round_trips
from sentrylake.llm.quality import BOILERPLATE, NAVIGATION, SYMBOLS, quality_rules
from sentrylake.llm.tokencounts import token_counts
from sentrylake.llm.tokens import vocabulary_path
from sentrylake.llm.toxicity import toxicity_scores
from sentrylake.llm.trie import conversation_trie
from sentrylake.llm.urls import url_verdicts
from sentrylake.llm.vectors import near_vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# The rules of sentrylake.llm.quality in SQL.
_WORD = "[^\\x20\\x09-\\x0D]"
ORACLES["op2_quality_rules"] = rf"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{_WORD}')] AS ls FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
rw AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, unnest([0, 1, 2]) AS s(o) GROUP BY doc_id),
li AS (SELECT doc_id, l, len(regexp_extract_all(l, '{_WORD}+')) AS n FROM d, unnest(ls) AS u(l)),
lost AS (SELECT doc_id, sum(n) AS n FROM li
  WHERE length(l) - length(translate(l, '{SYMBOLS}', '')) > n * 0.2::DOUBLE
    OR (n > 2 AND upper(l) = l AND lower(l) <> l)
    OR (n <= 4 AND NOT regexp_matches(l, '[.!?:;…"''”»)\]][\x20\x09\x0B-\x0D]*$'))
    OR regexp_matches(l, '{NAVIGATION}') OR regexp_matches(l, '(?i){BOILERPLATE}')
  GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rw.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_lost_words
  FROM d LEFT JOIN rw ON d.doc_id = rw.doc_id LEFT JOIN lost ON d.doc_id = lost.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_lost_words <= n_words * 0.3::DOUBLE AS kept FROM b"""


@query
def op2_quality_rules(spark, d):
    measured = quality_rules(table(spark, d, "documents"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"
    )


# All shortest runs of 50 words from and to every line, compared as text.
ORACLES["op4_line_dedup"] = rf"""WITH ls AS (
  SELECT doc_id, j, string_split(text, chr(10))[j] AS l FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(j)),
nb AS (SELECT doc_id, j, l, len(regexp_extract_all(l, '{_WORD}+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i
  FROM ls WHERE regexp_matches(l, '{_WORD}')),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM nb),
runs AS (SELECT a.doc_id, a.i AS a, min(e.i) AS e FROM c a JOIN c e ON a.doc_id = e.doc_id AND e.i >= a.i AND e.c - a.c + a.n >= 50 GROUP BY a.doc_id, a.i
  UNION SELECT e.doc_id, max(a.i), e.i FROM c a JOIN c e ON a.doc_id = e.doc_id AND e.i >= a.i AND e.c - a.c + a.n >= 50 GROUP BY e.doc_id, e.i),
k AS (SELECT r.doc_id, r.a, r.e, string_agg(c.l, chr(10) ORDER BY c.i) AS k FROM runs r JOIN c ON c.doc_id = r.doc_id AND c.i BETWEEN r.a AND r.e GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, a) AS place FROM k),
gone AS (SELECT DISTINCT c.doc_id, c.j FROM f JOIN c ON c.doc_id = f.doc_id AND c.i BETWEEN f.a AND f.e WHERE place > 1)
SELECT ls.doc_id, coalesce(string_agg(ls.l, chr(10) ORDER BY ls.j) FILTER (WHERE gone.j IS NULL), '') AS text,
  count(*) FILTER (WHERE regexp_matches(ls.l, '{_WORD}')) AS n_lines, count(gone.j) AS n_removed
FROM ls LEFT JOIN gone ON ls.doc_id = gone.doc_id AND ls.j = gone.j GROUP BY ls.doc_id"""


@query
def op4_line_dedup(spark, d):
    return line_dedup(table(spark, d, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query
def op8_minhash_near_dedup(spark, d):
    return near_duplicates(table(spark, d, "documents"))


@query
def op10_best_fit_packing(spark, d):
    return pack_documents(table(spark, d, "documents"), vocabulary_path("word_bpe_49k.json"), capacity=2048)


@query
def op9_toxicity(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return toxicity_scores(docs, table(spark, d, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op1_lm_scores(spark, d):
    """Held-out rows are those whose id's checksum leaves 1 when divided by 5; a null id is learned from."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    scores = lm_scores(table(spark, d, "documents"), ~out)
    return scores.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_token_counts(spark, d):
    return token_counts(table(spark, d, "documents"), vocabulary_path("byte_bpe_50k.json"), limit=1024)


@query
def op7_sentencepiece(spark, d):
    return round_trips(table(spark, d, "documents"), vocabulary_path("piece_bpe_32k.model"))


@query
def op6_embedding_near_dedup(spark, d):
    return near_vectors(table(spark, d, "embeddings"))


@query
def op3_html_main_text(spark, d):
    return main_text(table(spark, d, "pages"))


# The rules of the contract.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
_RULE_VALUES = ", ".join(str(r) for r in URL_RULES)
ORACLES["op13_url_filters"] = rf"""WITH r(verdict, h, p) AS (VALUES {_RULE_VALUES}),
a AS (SELECT page_id, row_number() OVER () AS i, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, i, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
f AS (SELECT i, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM u JOIN r
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (i)"""


@query
def op13_url_filters(spark, d):
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_verdicts(table(spark, d, "pages"), rules)


# CRC-32 bit by bit, rebuilt conversations, every prefix as a list, and a node's subtree as the prefixes that start with it.
ORACLES["op11_prefix_trie"] = """WITH RECURSIVE o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5('t' || length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(t ORDER BY i) AS own FROM o GROUP BY conv_id),
crc(conv_id, s, i, r) AS (SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM c
  UNION ALL SELECT conv_id, s, i + 1, list_reduce([xor(r, ord(s[i + 1])), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x // 2, (x % 2) * 3988292384))
  FROM crc WHERE i < length(s)),
h AS (SELECT conv_id, (4294967295 - r) % 6 AS h FROM crc WHERE i = length(s)),
b AS (SELECT c.conv_id, coalesce(list_slice(f.own, 1, h), []) || list_slice(c.own, h + 1, len(c.own)) AS seq
  FROM c JOIN h USING (conv_id) LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, d, list_slice(seq, 1, d) AS k, d = len(seq) AS ends FROM b, unnest(range(0, len(seq) + 1)) AS u(d)),
n AS (SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY k),
ch AS (SELECT list_slice(k, 1, depth - 1) AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(ch.n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * length(n.k[depth].text) ELSE 0 END AS saved FROM n LEFT JOIN ch ON ch.k = n.k),
s AS (SELECT list_slice(k, 1, a) AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM v, unnest(range(0, depth + 1)) AS u(a) GROUP BY 1)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s ON s.k = v.k LEFT JOIN v q ON v.depth > 0 AND q.k = list_slice(v.k, 1, v.depth - 1)"""


@query
def op11_prefix_trie(spark, d):
    return conversation_trie(table(spark, d, "conversations"))


@query
def op12_tokenizer_alignment(spark, d):
    return tokenizer_alignment(table(spark, d, "documents"), vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model"))
