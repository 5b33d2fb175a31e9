"""Registered queries of the operators of this package, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import (collision_dedup, conversation_repair, decontamination, html_template, line_dedup, order_minhash, packing,
                          secret_scan, sharding, suffix_dedup, syncmers, token_alignment,
                          toxicity)
from linkloom.session import scratch_path

OLD_SHARDS, SHARDS = 12, 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lie in 12 shards by source move to 16 shards of near-equal bytes; digests of the written files."""
    docs = _table(spark, sf_dir, "documents")
    old = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS))
    rows = sharding.reshard(docs, old, OLD_SHARDS, SHARDS)
    path = scratch_path(spark, "shards")
    sharding.rewrite_affected(rows, path)
    text = F.coalesce("doc.text", F.lit(""))
    return (sharding.read_shards(rows, path)
            .select("doc.doc_id", (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "old_shard"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, report=True)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.group_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_documents(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op7_collision_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return (suffix_dedup.cut_repeats(docs)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(conversation_repair.damage(_table(spark, sf_dir, "conversations")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_syncmer_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_reshard, op2_line_dedup, op3_secret_scan, op4_order_minhash, op5_main_text, op6_toxicity,
                            op7_collision_dedup, op8_suffix_dedup, op9_decontamination, op10_packing, op11_conversation_repair,
                            op12_token_alignment, op13_syncmer_fingerprint)}

# Runs of at least three units (a line of w words has ceil(w / 25)) that occurred earlier in document order.
_LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, pos, line, u.part
  FROM (SELECT *, len(regexp_extract_all(line, '\S+')) AS n FROM lines) l,
       LATERAL (SELECT unnest(range(0, CAST(ceil(l.n / 25.0) AS BIGINT))) AS part) u),
grams AS (
  SELECT doc_id, pos, lead(pos, 1) OVER w AS pos2, lead(pos, 2) OVER w AS pos3, row_number() OVER w AS start,
         md5(line) || part AS a, lead(md5(line) || part, 1) OVER w AS b, lead(md5(line) || part, 2) OVER w AS c
  FROM units WINDOW w AS (PARTITION BY doc_id ORDER BY pos, part)),
later AS (
  SELECT doc_id, pos, pos2, pos3,
         row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, start) > 1 AS again
  FROM grams WHERE c IS NOT NULL),
gone AS (
  SELECT doc_id, pos FROM later WHERE again UNION SELECT doc_id, pos2 FROM later WHERE again
  UNION SELECT doc_id, pos3 FROM later WHERE again),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
         count(*) AS n_lines, count(g.pos) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLE_SQL: dict[str, str] = {"op2_line_dedup": _LINE_DEDUP}
