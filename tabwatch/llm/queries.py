"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabwatch.llm import (centroids, collocations, decontam, exact_dedup, html_extract, license_scan,
                          line_dedup, minhash, sp_codec, token_count, token_store, toxicity, warc)
from tabwatch.plans.tables import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.tokens_digest(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.codec_report(table(spark, sf_dir, "documents"), PIECE_BPE)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark")).drop("text_hash")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("h")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_token_store, op2_license_scan, op3_sentencepiece, op4_exact_dedup, op5_html_extract,
    op6_decontamination, op7_minhash, op8_warc, op9_token_count, op10_toxicity, op11_collocations,
    op12_line_dedup, op13_centroids)}

ORACLE = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op4_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (
  PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) AS k FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size, k = 1 AS kept, sha256(t) AS text_sha256 FROM d""",
    "op6_decontamination": decontam.oracle_sql(),
    "op8_warc": f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= {warc.MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM r""",
    "op11_collocations": collocations.oracle_sql(),
    "op12_line_dedup": line_dedup.oracle_sql(),
    "op13_centroids": centroids.oracle_sql(),
}
