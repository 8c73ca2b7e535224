"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.llm import bpe, chat_format, decontaminate, hard_negatives, html_text, id_coder, jaccard, prefix_trie, suffix_dedup, suffix_tree, topk, toxicity, urls
from creditweave.llm.common import documents, remainder, ship_code

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

#: The URL rules of the query.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), URL_RULES, urls.labelled_urls(spark))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op4_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), BYTE_BPE)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return suffix_dedup.deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def op7_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(documents(spark, sf_dir).select("doc_id", "text"), remainder(F.col("doc_id"), 7) != 2)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op9_id_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_coder.ids_round_trip(documents(spark, sf_dir).select("doc_id", "text"), BYTE_BPE)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "best_window", "matched_words")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    said = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return chat_format.digests(chat_format.format_chats(turns.unionByName(added)))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

#: The rule alone: equal words along every alignment, whatever seeds it may have.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(w) word, generate_subscripts(w, 1) p
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') w FROM documents)),
i AS (
  SELECT r, item_id, len(w) n, unnest(w) word, generate_subscripts(w, 1) q
  FROM (SELECT row_number() OVER () r, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') w FROM benchmark)),
m AS (SELECT doc_id, r, item_id, n, p - q AS off, q FROM d JOIN i ON d.word = i.word),
c AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, r, off) matched,
    count(*) OVER (PARTITION BY doc_id, r, off ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) here FROM m),
s AS (SELECT doc_id, r, item_id, n, off, max(here) best, max(matched) matched FROM c GROUP BY ALL)
SELECT doc_id, item_id, CAST(max(best) AS INT) AS best_window, CAST(max(matched) AS INT) AS matched_words
FROM s WHERE best >= CASE WHEN n >= 13 THEN 11 ELSE ceil(n * 0.8) END GROUP BY doc_id, item_id
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id anchor_id, v.vec_id, a.label = v.label same, CAST(list_dot_product(a.e, v.e) AS BIGINT) score
  FROM v a JOIN v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id positive_id, score positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.*, s.vec_id negative_id, s.score negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

#: CRC-32 of an id's decimal text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

#: Paths are lists of turn digests; a node gives its share to each beginning of its own path.
OP12_SQL = rf"""
WITH o AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, x) k
  FROM (SELECT conv_id c, turn, coalesce(role, '') r, coalesce(text, '') x FROM conversations WHERE conv_id IS NOT NULL)),
i AS (SELECT c, c - c % 20 b, {_CRC} % 4 h FROM (SELECT DISTINCT c FROM o)),
rb AS (
  SELECT i.c, 0 part, k, r, x FROM i JOIN o ON o.c = i.b AND k <= h
  UNION ALL SELECT i.c, 1, k, r, x FROM i JOIN o ON o.c = i.c AND k > h),
d AS (
  SELECT c, row_number() OVER w d, list(sha256(concat(length(r), ':', r, x))) OVER w p,
    len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) words
  FROM rb WINDOW w AS (PARTITION BY c ORDER BY part, k)),
a AS (SELECT c, d, p, words FROM d UNION ALL SELECT c, 0, [], 0 FROM i),
l AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ended FROM a),
n AS (
  SELECT p, d, min(c) conv_id, count(*) n_convs, min(words) words,
    sha256(coalesce(string_agg(CASE WHEN ended THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) ends_sha256 FROM l GROUP BY p, d),
ch AS (SELECT p[: d - 1] p, count(*) n_children FROM n WHERE d > 0 GROUP BY ALL),
nc AS (SELECT n.*, coalesce(n_children, 0) n_children FROM n LEFT JOIN ch ON ch.p = n.p),
sh AS (SELECT p, unnest(range(0, d + 1)) k, n_children = 0 AS leaf, (n_convs - 1) * words saved FROM nc),
su AS (SELECT p[: k] p, count(*) FILTER (leaf) n_leaves, sum(saved) saved_tokens FROM sh GROUP BY ALL)
SELECT nc.conv_id, nc.d AS depth, up.conv_id AS parent_conv_id, nc.n_convs, nc.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nc.ends_sha256
FROM nc JOIN su ON su.p = nc.p LEFT JOIN n up ON nc.d > 0 AND up.p = nc.p[: nc.d - 1]
"""

#: What is read back is what went in; the length follows from the marks and the codes for control strings.
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') x FROM conversations
  UNION ALL SELECT -7, k, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(x, '\', '\a'), '### System: ', '\b'), '### User: ', '\c'), '### Assistant: ', '\d'),
      '### Role: ', '\e'), '</role> ', '\f'), '</turn>', '\g') y,
    CASE r WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 ELSE 18 + length(r) END + 8 AS marks,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) k FROM t),
f AS (SELECT *, CASE WHEN k = 1 THEN 'start' ELSE lag(r) OVER (PARTITION BY conv_id ORDER BY k) END AS state FROM e),
g AS (
  SELECT *, CASE WHEN NOT coalesce(k = 1 AND r IN ('system', 'user') OR k > 1 AND r = 'user' AND state IN ('system', 'assistant')
    OR k > 1 AND r = 'assistant' AND state = 'user', false) THEN concat('turn ', k, ': ', r, ' after ', state) END AS refused FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(r, chr(10), x, chr(10)), '' ORDER BY k)) AS turns_sha256,
  coalesce(CAST(sum(length(x)) FILTER (r = 'assistant') AS BIGINT), 0) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY k) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marks + length(y)) AS BIGINT) AS formatted_chars,
  coalesce(first(refused ORDER BY k) FILTER (refused IS NOT NULL), CASE WHEN last(r ORDER BY k) <> 'assistant' THEN 'ends after ' || last(r ORDER BY k) END) AS error
FROM g GROUP BY conv_id
"""


def _with_code(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


_ALL = {
    "op1_topk_search": op1_topk_search,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_bpe_coding": op4_bpe_coding,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_suffix_tree_score": op7_suffix_tree_score,
    "op8_html_text": op8_html_text,
    "op9_id_coder": op9_id_coder,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_chat_format": op13_chat_format,
}
QUERIES = {name: _with_code(query) for name, query in _ALL.items()}

ORACLES: dict[str, str] = {
    "op1_topk_search": OP1_SQL,
    "op6_jaccard_join": OP6_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_chat_format": OP13_SQL,
}
