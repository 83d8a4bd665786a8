"""The registered queries, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.llm import (
    classifier, decontaminate, line_dedup, mixing, negatives, packing, quality_rules, secrets, simhash, spelling, substring_dedup, tokens, warc,
)
from riskmart.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", F.round("score", 6).alias("score"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = tokens.TokenConfig(public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.token_counts(table(spark, sf_dir, "documents"), config)


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS size
  FROM documents GROUP BY doc_id, source),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100.0::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goal AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce(max(level) FILTER (WHERE level * weight <= cap) OVER () * weight, cap::DOUBLE)) AS target
  FROM levels),
queued AS (
  SELECT s.*, p.pass, g.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY p.pass, md5(concat_ws('|', s.source, p.pass, s.doc_id)), s.doc_id, s.size
                           ROWS UNBOUNDED PRECEDING) AS offered
  FROM sized s CROSS JOIN (VALUES (0), (1)) p(pass) JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
finished AS (
  SELECT *, CASE WHEN target > 0 THEN offered / target ELSE 0 END AS finish FROM queued),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, pass, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS until
  FROM finished),
taken AS (
  SELECT doc_id, source, sum(size)::BIGINT AS taken FROM placed
  WHERE until - size / 2 <= (SELECT sum(source_size) * 150 / 100.0::DOUBLE FROM goal) GROUP BY doc_id, source)
SELECT s.doc_id, s.size, g.source_size, g.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
LEFT JOIN taken t ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.source IS NOT DISTINCT FROM t.source
"""


@query("op9_mixing", OP9_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(CASE WHEN payload_bytes >= 100 THEN page_id END) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


@query("op8_warc_bundles", OP8_SQL)
def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT r, t, 0 AS kind, regexp_extract_all(t, p) AS hits, string_split_regex(t, p) AS gaps, regexp_extract_all(t, p, 2) AS secret
  FROM d, (SELECT '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL SELECT r, t, 1, regexp_extract_all(t, p), string_split_regex(t, p), NULL FROM d, (SELECT 'AKIA[A-Z0-9]{12,}' AS p)
  UNION ALL SELECT r, t, 2, regexp_extract_all(t, p), string_split_regex(t, p), NULL FROM d, (SELECT '[0-9a-f]{32,}' AS p)
  UNION ALL SELECT r, t, 3, regexp_extract_all(t, p), string_split_regex(t, p), NULL FROM d, (SELECT '[A-Za-z0-9+/_=-]{20,}' AS p)),
each_hit AS (SELECT r, kind, hits, gaps, secret, unnest(range(1, len(hits) + 1)) AS i FROM found),
placed AS (
  SELECT r, kind, hits[i] AS hit, secret[i] AS secret,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
  FROM each_hit),
base AS (SELECT r, kind, s::BIGINT AS s, (s + length(hit))::BIGINT AS e FROM placed WHERE kind < 3 AND (kind > 0 OR length(secret) >= 8)),
parts AS (
  SELECT r, s, string_split_regex(hit, p) AS gaps, regexp_extract_all(hit, p) AS words
  FROM placed, (SELECT '(?i)(?:example|sample|dummy|placeholder|changeme|xxxxx|0123456789|abcdefghij)' AS p) WHERE kind = 3),
each_part AS (SELECT r, s, gaps, words, unnest(range(1, len(gaps) + 1)) AS i FROM parts),
candidates AS (
  SELECT r, gaps[i] AS hit, s + coalesce(list_sum(list_transform(gaps[1:i - 1], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(words[1:i - 1], lambda x: length(x))), 0) AS s
  FROM each_part),
runs AS (
  SELECT r, s, hit, CASE WHEN regexp_full_match(hit, '[0-9a-fA-F]+') THEN 3.05 WHEN regexp_full_match(hit, '[A-Za-z]+') THEN 4.05 ELSE 3.85 END AS bits
  FROM candidates WHERE length(hit) >= 20 AND NOT regexp_matches(hit, '^[0-9]+$')
    AND NOT regexp_matches(hit, '(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$') AND NOT regexp_matches(hit, '^/?([a-z0-9_-]+/){2,}[a-z0-9_-]*$')),
windows AS (SELECT r, s AS run, hit, bits, unnest(range(0, length(hit) - 19)) AS pos FROM runs),
dense AS (SELECT r, run, pos FROM windows WHERE list_entropy(string_split(substring(hit, (pos + 1)::BIGINT, 20), '')) >= bits),
marked AS (SELECT *, coalesce(pos - lag(pos) OVER w > 20, true)::INTEGER AS fresh FROM dense WINDOW w AS (PARTITION BY r, run ORDER BY pos)),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY r, run ORDER BY pos) AS island FROM marked),
spans AS (SELECT r, 3 AS kind, (run + min(pos))::BIGINT AS s, (run + max(pos) + 20)::BIGINT AS e FROM islands GROUP BY r, run, island),
added AS (SELECT * FROM spans WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = spans.r AND base.s <= spans.s AND spans.e <= base.e)),
every_span AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s || ':' || e AS name FROM (SELECT * FROM base UNION ALL SELECT * FROM added)),
joined AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
         count(*) FILTER (WHERE kind = 3) AS n_entropy, string_agg(name, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 3) AS base,
         string_agg(name, ',' ORDER BY s, kind, e) AS spans
  FROM every_span GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM d LEFT JOIN joined USING (r)
"""


@query("op3_secret_scan", OP3_SQL)
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_decisions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("dropped").alias("n_dropped"), F.concat_ws(",", F.col("dropped").cast("array<string>")).alias("dropped"))


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "other_id", "other_start", "other_end", F.round("identity", 6).alias("identity"))


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = packing.PackConfig(public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(table(spark, sf_dir, "documents"), config)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.quantised(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
