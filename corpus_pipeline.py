"""Corpus pipeline: toxic documents go, then exact copies, near copies and documents that hold
benchmark items; what stays is encoded. Each stage reads what its predecessor wrote.

All stages read whole texts, however long, take a null text for an empty one (which is never toxic, near to
another or a leak), keep further columns whatever their names as they were up to the last stage, and give an
empty table for an empty one. Null ids are ids like others."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.llm import decontam, exact_dedup, minhash, sp_codec, toxicity
from tabwatch.llm.common import shared_dir, stored
from tabwatch.plans.tables import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. Repeated rows share their text's fate; without
    labels all stay."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null and empty ones included, the document with the largest id (null ids are
    smallest); of rows equal in id and text, one."""
    return exact_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id. Texts without words are
    in no group."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Items or texts of under five words match nothing; with no
    items all stay."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and whether decoding gives back the text. Empty text: no ids, lossless.
    Further columns end here."""
    d = sp_codec.decode_documents(sp_codec.encode_documents(docs, MODEL), MODEL)
    return d.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
                    (F.col("text") == F.col("decoded")).alias("lossless"))


STAGES = [("toxicity", clean_documents), ("exact_dedup", exact_duplicates),
          ("near_dedup", near_duplicates), ("decontamination", decontaminate),
          ("sentencepiece", encode)]

# Scores and segmentations have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    folder = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
