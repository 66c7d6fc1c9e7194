"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents, with texts and n_chars
as the stage leaves them. Rows are told apart by their file and place in it, so null and
repeated doc_ids are documents like others; names of such columns are made to differ from the caller's.

quality rules: a null, empty or short text goes, as do depleted ones; boilerplate lines leave the others.
line dedup: every row stays, null texts stay null, and a text may become empty; rows with equal doc_ids
keep that doc_id's lines. near-duplicates: the first row of each group stays, repeated rows are copies;
null and wordless texts stay. mixing: rows leave, or come twice; wordless ones weigh nothing and
may stay. packing: every row gives pieces, an empty text one of the end id alone.
Empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.llm import line_dedup, mixing, near_dups, packing, quality, storage

#: The tilts and greedy fills of the last two stages are iterative, and so is connecting similar lines.
ORACLE_SQL = None


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a row number that stays, and its column."""
    storage.bounded_batches(docs.sparkSession)
    row = storage.free_name(docs, "__row")
    return storage.row_numbers(docs, row), row


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    return quality.cleaned(rows, quality.judged(rows, row=row), row).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    storage.bounded_batches(spark)
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    found = near_dups.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle=5, percent=80)
    copies = storage.materialize(found.where("doc_id != component_id").select(F.col("doc_id").alias(row)), "copies")
    return rows.join(storage.small(copies), row, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    copies, copy = storage.free_name(rows, "__copies"), storage.free_name(rows, "__copy")
    dealt = mixing.mix(rows, row=row).where("copies > 0").select(F.col("row_id").alias(row), F.col("copies").alias(copies))
    dealt = rows.join(storage.small(storage.materialize(dealt, "dealt")), row)
    return dealt.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    storage.bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-duplicates", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote on its way is deleted when its result is written, and that when the next one is."""
    docs, before = storage.documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        path = storage.new_path(spark, name.replace(" ", "-"))
        with storage.cleared(spark):
            docs = storage.written(stage(spark, docs, sf_dir), path)
        storage.delete(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
