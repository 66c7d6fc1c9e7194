"""Token ids as Parquet list columns, written in document order and read back selectively.

Documents are range-partitioned by doc_id, so file k holds a contiguous run of the order (null ids
first; rows with equal ids by a hash of the text, then by text, so that many such rows aren't one range). A row stores its place inside its file; the place in
the whole corpus follows from the files' totals, one small row a file. Ids are dictionary encoded
(or delta encoded) in row groups of a set size with page indexes, so a reader of a few documents
or of the metadata columns alone touches only the pages that it needs.

Null texts count as empty: their only id is the end id. Empty input writes no rows. Other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamark.llm.tokens import crc32s, encoder, text_chunks

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"


def file_options(encoding: str, row_group_bytes: int, page_rows: int) -> dict[str, str]:
    """Parquet settings: ``encoding`` is "dictionary" or "delta"; page indexes are written with either."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    return {
        "compression": "zstd",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.dictionary.page.size": str(4 << 20),
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }


def encode_in_order(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for low, high in text_chunks(texts):
                coded = encoder(tokenizer, end_id).encode(texts.slice(low, high - low))
                first = coded.offsets.to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(np.full(len(coded), part, np.int32)), pa.array(at + first[:-1]), pa.array(np.diff(first)), coded],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"],
                )
                at += int(first[-1])

    tie = F.xxhash64("text").alias("tie")
    ordered = docs.select(F.col("doc_id").cast("long"), "text", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    return ordered.mapInArrow(encode, FILE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_rows: int = 1000) -> None:
    """Writes the ids of every document, each with the end id appended, as a Parquet dataset at ``path``."""
    encode_in_order(docs, tokenizer, end_id).write.options(**file_options(encoding, row_group_bytes, page_rows)).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Columns doc_id, start, n_tokens, ids; columns that aren't selected aren't read.

    ``start`` counts the ids of all documents before this one.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = files.select("part", before.alias("base"))
    # one row of 12 bytes for each file that was written
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("local_start") + F.col("base")).alias("start"), "n_tokens", "ids")


def ids_crc32(rows: DataFrame) -> DataFrame:
    """Replaces ``ids`` by the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            sums = crc32s(lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
