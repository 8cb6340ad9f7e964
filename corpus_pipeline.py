"""The corpus pipeline: documents in a known language, one of each near-duplicate group, without repeated passages, mixed to
target weights and encoded. Each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.llm import bpe, language, mixing, simhash, suffix_dedup
from garimpo.session import settle


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those of which the network does not hold one language for likelier than all others, go."""
    return language.known_language(docs, 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints exactly one stays, the one with the smallest id.

    Links are those of four-word fingerprints within 4 bits: most pairs of a five-word similarity of 0.9 or less are not linked,
    see the README for the share by similarity.

    Rows with a null id come last in their group, and of rows with one id the first in the table stays. Rows are told apart by
    their file and place in `docs`, a written table, so that repeated rows and ids don't matter, nor how a job deals the files.
    """
    row = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    placed = docs.select(F.struct("*").alias("_doc"), row.alias("_row"))
    doc_id = F.col("_doc")["doc_id"]
    order = F.struct(doc_id.isNull().alias("unknown"), doc_id.alias("id"), F.col("_row").alias("row"))
    groups = simhash.near_duplicates(placed.select(order.alias("_order"), F.col("_doc")["text"].alias("text")), "_order")
    kept = groups.where("doc_id = component_id").select(F.col("doc_id.row").alias("_row"))
    return placed.join(kept, "_row", "left_semi").select(*[F.col("_doc")[c].alias(c) for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once go from all texts; n_chars follows the text."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time the mix takes a document."""
    return mixing.mixed_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of each text, as their hashes."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("bpe", encoded),
]

# A trained network and tokenizer are no matter for SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
