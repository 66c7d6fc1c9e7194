"""Line sources: directories of plain and compressed text, message queues and sockets.

Spark's text reader serves files whose names tell their compression, ``line_files`` all others, archives among them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.sources.line_files import MAX_LINE_BYTES, LineFiles
from seamark.sources.live import TcpSource, WebSocketSource


def stem(path: Column) -> Column:
    """The name of a file without its directories and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def within_limit(lines: DataFrame, limit: int = MAX_LINE_BYTES) -> DataFrame:
    return lines.where(F.octet_length("payload") < limit)


def scan_text(spark: SparkSession, root: str) -> DataFrame:
    """payload, source (the file's stem), file and arrival_ms (its last change) of plain, .gz and .bz2 files."""
    read = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(root)
    told = read.select(F.rtrim(F.col("value"), F.lit("\r")).alias("payload"), F.col("_metadata.file_path").alias("file"), F.unix_millis("_metadata.file_modification_time").alias("arrival_ms"))
    return within_limit(told.withColumn("source", stem(F.col("file"))).where("payload != ''"))


def listed(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, size and mtime_ms of all files under the roots, hidden ones left out; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return files.select("path", F.col("length").alias("size"), F.unix_millis("modificationTime").alias("mtime_ms"))


def scan_any(spark: SparkSession, root: str) -> DataFrame:
    """The lines of all files under a root, plain, compressed or in archives, but for empty ones and those over the limit."""
    spark.dataSource.register(LineFiles)
    return spark.read.format("seamark_lines").load(root).where("payload != ''")


def message_lines(messages: DataFrame, limit: int = MAX_LINE_BYTES) -> DataFrame:
    """One row per line of each message's value; a message with a line at or over the limit is dropped whole."""
    cut = messages.withColumn("__lines", F.split(F.col("value").cast("string"), "\n"))
    short = cut.where(F.array_max(F.transform("__lines", F.octet_length)) < limit)
    rest = [c for c in messages.columns if c != "value"]
    return short.select(*rest, F.posexplode("__lines").alias("line", "payload")).where("payload != ''")


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_offsets: int = 1_000_000) -> DataFrame:
    """A stream of a topic's lines; offsets are kept in the query's checkpoint. Needs Spark's Kafka package."""
    read = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(max_offsets), "kafka.session.timeout.ms": "6000"}).load()
    return message_lines(read.select("value", F.unix_millis("timestamp").alias("arrival_ms"), F.col("topic").alias("source")))


def tcp(spark: SparkSession, host: str, port: int, source: str, buffer: str, limit: int = MAX_LINE_BYTES) -> DataFrame:
    """A stream of a TCP server's lines, joined again when it drops; ``buffer`` is a shared folder for lines that aren't committed."""
    spark.dataSource.register(TcpSource)
    options = {"host": host, "port": str(port), "source": source, "buffer": buffer, "maxLineLength": str(limit)}
    return spark.readStream.format("seamark_tcp").options(**options).load()


def websocket(spark: SparkSession, url: str, first_message: str, source: str, buffer: str, limit: int = MAX_LINE_BYTES) -> DataFrame:
    """A stream of a WebSocket's messages, which the first message asks for."""
    spark.dataSource.register(WebSocketSource)
    options = {"url": url, "subscription": first_message, "source": source, "buffer": buffer, "maxLineLength": str(limit)}
    return spark.readStream.format("seamark_websocket").options(**options).load()


def subscription_message(key: str, boxes: list[list[list[float]]], mmsis: list[str] = (), types: list[str] = ()) -> str:
    """The first message to a feed of AIS messages as JSON: its key, boxes (two corners each, latitude first), ships and message types."""
    told: dict = {"APIKey": key, "BoundingBoxes": boxes}
    if mmsis:
        told["FiltersShipMMSI"] = [str(m) for m in mmsis]
    if types:
        told["FilterMessageTypes"] = list(types)
    return json.dumps(told)


def subscription(positions: DataFrame, boxes: list[tuple[float, float, float, float]], mmsis: list[int] | None = None, types: list[int] | None = None) -> DataFrame:
    """The filters of a feed's subscription: any of the boxes (south, west, north, east), ships and message types."""
    inside = F.lit(not boxes)
    for south, west, north, east in boxes:
        inside = inside | (F.col("latitude").between(south, north) & F.col("longitude").between(west, east))
    kept = positions.where(inside)
    kept = kept.where(F.col("mmsi").isin(*mmsis)) if mmsis else kept
    return kept.where(F.col("msg_type").isin(*types)) if types else kept
