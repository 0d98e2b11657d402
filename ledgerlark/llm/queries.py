"""The operators' queries over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (bpe, collocations, decontam, hard_negatives, language, near_dup, quality,
                            repeats, token_counts, topk, toxicity, url_filter, warc)
from ledgerlark.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.repeat_digests(repeats.without_repeats(docs))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hit_digests(decontam.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return token_counts.token_counts(table(spark, sf_dir, "documents"), file.read())


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_bpe_round_trip, op2_exact_top_k, op3_near_duplicates, op4_quality, op5_language,
        op6_warc_round_trip, op7_repeated_strings, op8_toxicity, op9_decontamination,
        op10_url_filter, op11_token_counts, op12_collocations, op13_hard_negatives)
}

ORACLE: dict[str, str] = {
    "op2_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5""",
    "op3_near_duplicates": """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN l ON l.x = r.y),
c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op6_warc_round_trip": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, bytes) AS first FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    (['0000','0001','0010','0011','0100','0101','0110','0111',
      '1000','1001','1010','1011','1100','1101','1110','1111'])[strpos('0123456789abcdef', h[i])]), '') AS bits
  FROM f)
SELECT page_id, bytes AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT)
    + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM b""",
    "op9_decontamination": """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
s AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest(list_transform(
    range(1, greatest(len(ws) - 10, 0) + 2), lambda j: array_to_string(ws[j:j + 9], ' '))) AS t
  FROM i WHERE len(ws) > 0),
d AS (
  SELECT doc_id, k, first, array_to_string(ws[first:first + k - 1], ' ') AS t
  FROM (SELECT w.doc_id, w.ws, z.k, unnest(range(1, len(w.ws) - z.k + 2)) AS first
        FROM w, (SELECT DISTINCT k FROM s) z)),
m AS (SELECT d.doc_id, d.first, d.k, s.item_id FROM d JOIN s ON s.t = d.t AND s.k = d.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(first, first + k)) AS p FROM m) GROUP BY doc_id),
o AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(o.n, 0) AS n_items,
  sha256(coalesce(o.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN o USING (doc_id)""",
    "op12_collocations": """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM d),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
    lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
inner_phrases AS (
  SELECT lang, a, k, unnest(list_transform(range(1, k - z + 2),
    lambda i: array_to_string(ws[i:i + z - 1], ' '))) AS phrase
  FROM c, (SELECT unnest(range(2, 5)) AS z) WHERE z < k),
most AS (SELECT lang, phrase, max(a) AS around FROM inner_phrases GROUP BY lang, phrase),
kept AS (SELECT c.* FROM c LEFT JOIN most m ON m.lang = c.lang AND m.phrase = c.phrase
  WHERE m.around IS NULL OR 100 * m.around < 100 * c.a),
cut AS (
  SELECT kept.*, j, array_to_string(ws[1:j], ' ') AS p1, array_to_string(ws[j + 1:k], ' ') AS p2
  FROM kept, (SELECT unnest(range(1, 5)) AS j) WHERE j < k),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, x.f AS l, y.f AS r, n.n, j,
    (1000::HUGEINT * cut.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = p1 JOIN f y ON y.lang = cut.lang AND y.phrase = p2
  JOIN n ON n.lang = cut.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE nth = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS nth FROM s WHERE same)
  WHERE nth <= 5),
m AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM m WHERE rank <= 3""",
}
