"""Bronze partitions to the typed tables: choose, carry times, put together, decode, remove repetitions, write."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seamark.functions import hexagons, times
from seamark.jobs.config import DecodeConfig
from seamark.operators import catalogue, decode, dedup, jsonfeed, ordering, partitions

STATE = "_state"


def chosen(spark: SparkSession, config: DecodeConfig, now_ms: int) -> tuple[DataFrame, DataFrame, int | None]:
    """The files that the filters leave, the partitions to decode of them (year, ..., files), and the last run's watermark.

    A partition is one of time alone: if one source's part of it is new, all its sources are decoded again.
    """
    keys = list(times.GRAINS[: times.GRAINS.index(config.partition) + 1])
    files = partitions.listing(spark, list(config.input_dir)).where(config.filter(now_ms).condition(config.partition))
    previous = cutoff = None
    if config.incremental:
        # a dry run doesn't look at the output
        previous = None if config.dry_run else partitions.load_state(spark, f"{config.output_dir}/{STATE}")
        if previous is not None:
            cutoff = partitions.cutoff(previous)
        elif config.since is not None:
            cutoff = now_ms - config.since * 3_600_000
    return files, partitions.new_partitions(files, keys, cutoff), previous


def bronze(spark: SparkSession, config: DecodeConfig, parts: list[tuple] | None, now_ms: int) -> DataFrame:
    """source, file, line, arrival_ms, payload and the partition of the lines in ``parts`` (None: all that the filters leave).

    Tables that have no file and line are in the order of their files' rows.
    """
    keys = list(times.GRAINS[: times.GRAINS.index(config.partition) + 1])
    tables = []
    for root in config.input_dir:
        rows = partitions.read_partitioned(spark, [root], config.partition, config.filter(now_ms))
        if parts is not None:
            rows = rows.where(F.concat_ws("-", *[F.col(k).cast("int") for k in keys]).isin(["-".join(map(str, p)) for p in parts]))
        has = lambda name, other, rows=rows: F.coalesce(F.col(name), other) if name in rows.columns else other
        day = [F.lpad(F.col(k).cast("string"), 4 if k == "year" else 2, "0").alias(k) for k in keys]
        tables.append(rows.select(
            has("source", F.lit("default")).alias("source"), has("file", F.col("_metadata.file_path")).alias("file"), has("line", F.col("_metadata.row_index")).alias("line"),
            F.unix_millis("ts").alias("arrival_ms"), "payload", *day,
        ))
    first, *more = tables
    for rows in more:
        first = first.unionByName(rows)
    return first


def with_cells(rows: DataFrame) -> DataFrame:
    """Adds h3, the cell of about 15,000 square metres, to rows that have a place."""
    placed = {"latitude", "longitude"} <= set(rows.columns)
    return rows.withColumn("h3", hexagons.h3(F.col("latitude"), F.col("longitude"))) if placed else rows


def timed(lines: DataFrame, config: DecodeConfig) -> DataFrame:
    """Lines with ts_ms, whole sentences only where fragments are put together."""
    keys = [k for k in times.GRAINS if k in lines.columns]
    lines = ordering.resolve_timestamps(lines) if config.process_timestamps else lines.withColumn("ts_ms", F.col("arrival_ms"))
    if config.consolidate_ais:
        lines = ordering.reassemble(lines, ("source", "file", *keys))
    return lines


def run(spark: SparkSession, config: DecodeConfig, now_ms: int | None = None) -> dict[str, int]:
    """Decodes the chosen partitions into the tables under ``output_dir``; returns counters, or {"partitions": 0}.

    Lines are unpacked once and written by kind, so that each table reads only its own. Output partitions are those of
    the input, and a run replaces those that it writes, so decoding a partition again gives the same tables. Bronze tables
    only grow: a partition that had rows of a kind has them again. With a namespace, rows are added to its tables instead, and
    decoding a partition again adds them again. The watermark is saved after all tables are written.
    """
    config.validate()
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    files, parts, previous = chosen(spark, config, now_ms)
    if config.dry_run:
        return dict(parts.agg(F.count("*").alias("partitions"), F.coalesce(F.sum("files"), F.lit(0)).alias("files")).first().asDict())
    keys = list(times.GRAINS[: times.GRAINS.index(config.partition) + 1])
    parts = parts.persist()
    try:
        counted = parts.count()
        if not counted:
            return {"partitions": 0}
        # the changed partitions of a run, which are few beside the listed files; a full run names none
        names = [tuple(r[k] for k in keys) for r in parts.select(*keys).collect()] if config.incremental else None
        candidate = parts.agg(F.max("newest")).first()[0]
    finally:
        parts.unpersist()
    how = decode if config.feed == "nmea" else jsonfeed
    work = f"{config.scratch_dir or config.output_dir + '/_work'}/parsed"
    unpacked = how.parse(timed(bronze(spark, config, names, now_ms), config))
    unpacked.write.mode("overwrite").partitionBy("kind").parquet(work)
    parsed = spark.read.schema(unpacked.schema).parquet(work)
    counters = {"partitions": counted} | decode.stats(parsed).first().asDict() | {"rows_deduped": 0}
    eta_year = config.eta_year or time.gmtime(now_ms / 1000).tm_year
    for table, rows in how.route(parsed, eta_year).items():
        came = counters[f"{table}_out"]
        if not came:
            continue
        seen = Observation(table)
        kept = dedup.dedup(rows, table, ("ts_ms", "source", "file", "line"), config.partition, tuple(keys)).drop("line")
        kept = with_cells(kept) if config.h3 else kept
        order = ("hilbert", "ts_ms") if table in ("meteo", "atons") else ("ts_ms",)
        seen_rows = kept.observe(seen, F.count("*").alias("n"))
        if config.namespace is not None:
            name = catalogue.table_name(table, config.table_prefix, config.namespace)
            catalogue.append(seen_rows, name, config.partition, order, f"{config.output_dir}/{config.table_prefix or ''}{table}")
        else:
            partitions.replace_partitions(seen_rows, f"{config.output_dir}/{table}", keys, order, config.compression_level)
        counters[f"{table}_out"] = seen.get["n"]
        counters["rows_deduped"] += came - seen.get["n"]
    if config.incremental and candidate is not None:
        partitions.save_state(spark, f"{config.output_dir}/{STATE}", max(candidate, previous or 0))
    return counters
