"""Registered queries of the corpus operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quotebars.llm.decontam import find_contamination, is_contaminated
from quotebars.llm.exact_dedup import exact_dedup
from quotebars.llm.labelled import held_out
from quotebars.llm.merkle import verify_tampered
from quotebars.llm.near_dedup import kept, near_groups
from quotebars.llm.oracles import OP5_SQL, OP9_SQL, OP12_SQL, OP13_SQL
from quotebars.llm.order_minhash import compare_with_splices
from quotebars.llm.piece_bpe import round_trip
from quotebars.llm.quality import score_documents
from quotebars.llm.repair import damage, repair_conversations
from quotebars.llm.secrets import find_secrets
from quotebars.llm.sharding import assign_shards
from quotebars.llm.substring_dedup import remove_repeats
from quotebars.llm.tables import table
from quotebars.llm.toxicity import toxicity
from quotebars.llm.warc import read_archive, write_archive
from quotebars.session import scratch_dir

SHARDS = 24
PIECE_MODEL = "piece_bpe_32k.model"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "found.n_words", "found.n_hit",
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(_documents(spark, sf_dir), size=3, share=(85, 100))
    return groups.select("doc_id", "n_shingles", "component_id", kept().alias("kept"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "warc")
    records = read_archive(write_archive(table(spark, sf_dir, "pages"), root), root)
    return records.select("page_id", "payload_bytes", F.coalesce(F.sha2("payload", 256), "payload_digest").alias("payload_digest"),
                          "record_type", "refers_to")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_documents(spark, sf_dir)).withColumn("base", F.filter("secrets", lambda s: ~s["kind"].startswith("entropy")))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("secrets").alias("spans"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return scored.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.7).cast("int").alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(_documents(spark, sf_dir), SHARDS)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(_documents(spark, sf_dir), public_tokenizers.path(PIECE_MODEL))
    return rows.select("doc_id", (F.length("ids") - F.length(F.translate("ids", " ", "")) + 1).cast("long").alias("n_tokens"),
                       F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_splices(_documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_tampered(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_warc": op2_warc,
        "op3_secrets": op3_secrets,
        "op4_decontamination": op4_decontamination,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_quality": op6_quality,
        "op7_toxicity": op7_toxicity,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_sharding": op9_sharding,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_order_minhash": op11_order_minhash,
        "op12_merkle": op12_merkle,
        "op13_repair": op13_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": OP1_SQL, "op2_warc": OP2_SQL, "op4_decontamination": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op8_exact_dedup": OP8_SQL, "op9_sharding": OP9_SQL,
            "op12_merkle": OP12_SQL, "op13_repair": OP13_SQL}


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d
"""

OP2_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
o AS (
  SELECT payload_digest, min(page_id) AS owner FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, words[k:k + 2] AS shingle
  FROM w, unnest(range(1, greatest(len(words) - 1, 2))) AS t(k) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

OP4_SQL = rf"""
WITH i AS (
  SELECT item_id, words, least(13, len(words)) AS n FROM (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
  WHERE len(words) > 0),
win AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, words[k:k + n - 1] AS w FROM i, unnest(range(1, len(words) - n + 2)) AS t(k)),
d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
hits AS (
  SELECT doc_id, k, n, item FROM (
    SELECT doc_id, n, k, words[k:k + n - 1] AS w
    FROM d JOIN (SELECT DISTINCT n FROM i) ON n <= len(words), unnest(range(1, len(words) - n + 2)) AS t(k)) JOIN win USING (n, w)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM hits, unnest(range(k, k + n)) AS t(place) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
