"""The registered queries: each runs one operator over its whole table and returns its digest."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.llm import embeddings, infilling, langid, licenses, line_dedup, lm_scoring, mixing, near_dups, packing, prefix_trie, quality, storage, token_files, urls


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.documents(spark, sf_dir)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(storage.documents(spark, sf_dir)).drop("row_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.new_path(spark, "tokens")
    token_files.write_token_files(storage.documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.ids_crc32(token_files.read_token_files(spark, path))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(storage.documents(spark, sf_dir)))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.filter_urls(pages, urls.junk_urls(pages)).drop("possible")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(storage.documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = storage.documents(spark, sf_dir)
    model = langid.fit(docs.where(F.col("lang").isNotNull() & ~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(storage.documents(spark, sf_dir), shingle=2, percent=80)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines, and length and crc32 of the text that is left."""
    left = line_dedup.dedup_lines(storage.documents(spark, sf_dir))
    return left.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.crc32("text").alias("text_crc32"))


def op3_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.9)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its cuts, the hash of its output, and that of the text restored from the output."""
    cut = infilling.fill_in_middle(storage.documents(spark, sf_dir))
    text = infilling.restored(F.col("output"), F.col("form"))
    units = [F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars")]
    return cut.select("doc_id", "n", "form", *units, F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(storage.documents(spark, sf_dir), lm_scoring.held_out(F.col("doc_id")))
