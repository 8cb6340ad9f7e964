"""The registered queries of this subpackage and the SQL that checks them, where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from garimpo.llm import (
    ann,
    bpe,
    class_lm,
    extraction,
    language,
    mixing,
    prefix_trie,
    sharding,
    simhash,
    suffix_dedup,
    tandem_runs,
    vector_dedup,
    winnowing,
)
from workload.base import Query


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.lpt_shards(read(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), 0.98)


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(read(spark, sf_dir, "documents"))


def op7_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def repeating(docs: DataFrame) -> DataFrame:
    """Every tenth document or so gets a periodic end: its words from a on become those of a stretch of p words again and again."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def changed(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        places = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n == 0, "").otherwise(F.array_join(F.transform(places, lambda i: F.get(w, i)), " "))

    # The words are bound to a variable, so a text is split once and not for each of its words.
    periodic = F.transform(F.array(words), changed)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_tandem_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tandem_runs.tandem_runs(repeating(read(spark, sf_dir, "documents")))

    def before(x: Column, y: Column) -> Column:
        """Greater exponent first, compared exactly; then the smaller start and the smaller period."""
        longer, shorter = x["length"] * y["period"], y["length"] * x["period"]
        order = F.when(longer > shorter, -1).when(longer < shorter, 1)
        return order.when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int")).otherwise(
            F.signum(x["period"] - y["period"]).cast("int")
        )

    best = F.get(F.array_sort("runs", before), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.successors(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(read(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    root = F.col("conv_id") - F.col("conv_id") % 100
    return prefix_trie.prefix_trie(*prefix_trie.grafted(turns, head, 5, root))


QUERIES = [
    Query("op1_lpt_shards", op1_lpt_shards, None),
    Query("op2_nn_descent", op2_nn_descent, None),
    Query("op3_source_mix", op3_source_mix, mixing.SQL),
    Query("op4_byte_bpe", op4_byte_bpe, None),
    Query("op5_vector_dedup", op5_vector_dedup, vector_dedup.SQL),
    Query("op6_class_lm", op6_class_lm, None),
    Query("op7_line_blocks", op7_line_blocks, None),
    Query("op8_suffix_dedup", op8_suffix_dedup, None),
    Query("op9_simhash", op9_simhash, None),
    Query("op10_byte_cnn", op10_byte_cnn, None),
    Query("op11_tandem_runs", op11_tandem_runs, None),
    Query("op12_winnowing", op12_winnowing, None),
    Query("op13_prefix_trie", op13_prefix_trie, prefix_trie.SQL),
    Query("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
]
