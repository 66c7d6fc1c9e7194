"""A feed to bronze tables, for as long as it lasts: TCP, WebSocket or Kafka lines, written once, with a status file."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.jobs.config import ListenConfig
from seamark.sources import lines
from seamark.streaming import status, tables


def feed(spark: SparkSession, config: ListenConfig) -> DataFrame:
    """source, line, arrival_ms and payload of the configured feed."""
    kept = config.buffer_dir or f"{config.output_dir}/_buffer"
    if config.feed == "tcp":
        return lines.tcp(spark, config.tcp_host, config.tcp_port, config.source or "tcp", kept, config.max_line_length)
    if config.feed == "websocket":
        first = lines.subscription_message(config.api_key or "", json.loads(config.bounding_boxes), config.filter_mmsi, config.filter_message_types)
        return lines.websocket(spark, config.websocket_url, first, config.source or "websocket", kept, config.max_line_length)
    found = lines.kafka(spark, config.kafka_brokers, config.kafka_topic, config.kafka_auto_offset_reset)
    return found.select(F.lit(config.source).alias("source") if config.source else "source", "line", "arrival_ms", "payload")


def start(spark: SparkSession, config: ListenConfig):
    """Starts the query and, if a status file is named, the listener that writes it; returns both."""
    config.validate()
    listener = status.StatusListener(config.status_file) if config.status_file else None
    if listener:
        spark.streams.addListener(listener)
    rows = feed(spark, config)
    writer = rows.writeStream.queryName(config.name).option("checkpointLocation", config.checkpoint_dir or f"{config.output_dir}/_checkpoint")
    writer = writer.foreachBatch(lambda batch, number: tables.write_bronze(batch, config.output_dir, config.name, number, config.partition))
    return writer.trigger(processingTime=f"{config.seconds} seconds").start(), listener


def run(spark: SparkSession, config: ListenConfig, most_seconds: float | None = None) -> dict[str, int]:
    """Listens until the query fails, which raises, or for ``most_seconds``; returns the numbers of batches and lines."""
    query, listener = start(spark, config)
    try:
        began = time.monotonic()
        while most_seconds is None or time.monotonic() - began < most_seconds:
            if query.awaitTermination(1):
                break
        if most_seconds is not None and query.isActive:
            query.processAllAvailable() if config.feed == "kafka" else time.sleep(config.seconds + 1)
    finally:
        query.stop()
        if listener:
            spark.streams.removeListener(listener)
    told = query.recentProgress
    return {"batches": len([p for p in told if p.numInputRows]), "lines": sum(p.numInputRows for p in told)}
