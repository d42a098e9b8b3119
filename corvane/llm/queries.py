"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat_format, importance, language_id, license_scan, line_dedup, mixing, near_dedup, nearest, packing, quality_model, quality_rules, token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda vec_id: vec_id % 20 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*control.columns)
    return chat_format.digests(chat_format.chat_format(rows.unionByName(control)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_token_counts,
        op3_line_dedup,
        op4_nearest,
        op5_language_id,
        op6_best_fit_packing,
        op7_near_dedup,
        op8_mixing,
        op9_quality_model,
        op10_quality_rules,
        op11_importance,
        op12_chat_format,
    )
}

ORACLES = {
    "op3_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, pos, line, lower_key, length(lower_key) AS n
  FROM (
    SELECT doc_id, pos, line,
           translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents
    )
  )
),
hot AS (
  SELECT lower_key, max(doc_id) AS last_doc FROM lines WHERE n >= 20
  GROUP BY lower_key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT l.doc_id, l.pos, l.line, (h.lower_key IS NOT NULL AND l.doc_id <> h.last_doc) AS gone
  FROM lines l LEFT JOIN hot h ON l.lower_key = h.lower_key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_importance": r"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda x, k:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, c)) AS crc
),
found AS (
  SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark
),
worded AS (
  SELECT row_number() OVER () AS k, own, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM found
),
counted AS (
  SELECT k, own, word, count(*) AS n FROM (SELECT k, own, unnest(words) AS word FROM worded) GROUP BY ALL
),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
           list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
           lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
  FROM (SELECT word, hex(word) AS h FROM (SELECT DISTINCT word FROM counted)), table_of
),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE NOT own), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (word) GROUP BY bucket
),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS g
  FROM sums, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums)
),
weights AS (
  SELECT k, sum(n * g)::BIGINT AS weight FROM counted JOIN buckets USING (word) JOIN gain USING (bucket) WHERE own GROUP BY k
),
scored AS (
  SELECT k, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM worded LEFT JOIN weights USING (k) WHERE own
),
placed AS (
  SELECT k, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (k)
""",
    "op12_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
escaped AS (
  SELECT *, length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g'),
                                  '\[(/?INST\]|/?SYS\]|ROLE\]|/?TEXT\])', '[\\\1', 'g')) AS n FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(n + CASE role WHEN 'assistant' THEN 5 WHEN 'user' THEN 15 WHEN 'system' THEN 13 ELSE 19 + length(role) END))::BIGINT AS formatted_chars,
       false AS rewrites
FROM escaped GROUP BY conv_id
""",
}
