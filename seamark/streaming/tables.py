"""Micro-batches written once: a batch that runs again replaces what it wrote, in every table.

Each batch has directories of its own below the time partitions, named by the query and the batch, and overwrites just
these. Tables that a batch has finished are noted in a ledger beside them, so a batch that runs again only writes the others.
Lines go to the partition of their own time, however early or late; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.operators import decode, dedup, partitions
from seamark.streaming.reassembly import reassemble_stream

BATCH = "batch"
LEDGER = "_ledger"


class Ledger:
    """Which tables of a query's batches are finished; one small file each."""

    def __init__(self, spark: SparkSession, root: str, query: str):
        self.spark, self.path = spark, f"{root}/{LEDGER}/{query}"

    def finished(self, batch: int) -> set[str]:
        try:
            return {r["value"] for r in self.spark.read.text(f"{self.path}/{BATCH}={batch}").select("value").collect()}  # a row a table
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()

    def note(self, batch: int, table: str) -> None:
        self.spark.createDataFrame([(table,)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/{BATCH}={batch}")


def write_batch(rows: DataFrame, path: str, query: str, batch: int, grain: str, order: tuple[str, ...], level: int = 5) -> None:
    """Rows with ts_ms as the directories of this batch."""
    placed, names = partitions.in_partitions(rows, grain)
    partitions.replace_partitions(placed.withColumn(BATCH, F.lit(f"{query}-{batch}")), path, [*names, BATCH], order, level)


def write_tables(rows: DataFrame, root: str, query: str, batch: int, eta_year: int, grain: str = "day") -> None:
    """The six tables of one micro-batch of whole lines; they are unpacked once."""
    ledger = Ledger(rows.sparkSession, root, query)
    done = ledger.finished(batch)
    parsed = decode.parse(rows).persist()
    try:
        present = {r["kind"] for r in parsed.select("kind").distinct().collect()}  # eight kinds at most
        for table, some in decode.route(parsed, eta_year).items():
            if decode.KINDS[table] in present and table not in done:
                kept = dedup.dedup(some, table, ("source", "line", "payload"), grain).drop("line")
                write_batch(kept, f"{root}/{table}", query, batch, grain, ("hilbert", "ts_ms") if table in ("meteo", "atons") else ("ts_ms",))
                ledger.note(batch, table)
    finally:
        parsed.unpersist()


def write_bronze(rows: DataFrame, root: str, query: str, batch: int, grain: str = "day") -> None:
    """One micro-batch of lines as bronze: ts, file, line, payload."""
    told = rows.select("source", F.col("arrival_ms").alias("ts_ms"), F.concat(F.lit("stream:"), "source").alias("file"), "line", F.timestamp_millis("arrival_ms").alias("ts"), "payload")
    placed, names = partitions.in_partitions(told, grain)
    partitions.replace_partitions(placed.drop("ts_ms").withColumn(BATCH, F.lit(f"{query}-{batch}")), root, [*names, BATCH], ("ts", "line"))


def start(rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, query: str, available_now: bool):
    writer = rows.writeStream.queryName(query).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_tables(lines: DataFrame, root: str, checkpoint: str, query: str, eta_year: int, grain: str = "day", available_now: bool = True):
    """Starts the query that reassembles, decodes and writes a stream of lines; ``query`` names it for ever."""
    return start(reassemble_stream(lines).where("complete"), lambda rows, batch: write_tables(rows, root, query, batch, eta_year, grain), checkpoint, query, available_now)


def run_bronze(lines: DataFrame, root: str, checkpoint: str, query: str, grain: str = "day", available_now: bool = True):
    """Starts the query that writes lines (source, line, arrival_ms, payload) of any source to a root of its own, which ``jobs.decode`` reads."""
    return start(lines, lambda rows, batch: write_bronze(rows, root, query, batch, grain), checkpoint, query, available_now)
