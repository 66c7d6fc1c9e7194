"""Time partitions: filters that Spark prunes by, incremental choice of partitions, and layout of output."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions import times

#: How far back, in milliseconds, an incremental run looks behind the last one.
LAP_MS = 5000
PATH = r"(?:source=([^/]*)/)?year=(\d{4})(?:/month=(\d{2}))?(?:/day=(\d{2}))?(?:/hour=(\d{2}))?(?:/minute=(\d{2}))?"


@dataclass(frozen=True)
class PartitionFilter:
    """Fixed calendar values from the year on without gaps, or a rolling lower bound in milliseconds; and a source."""

    year: int | None = None
    month: int | None = None
    day: int | None = None
    hour: int | None = None
    minute: int | None = None
    since_ms: int | None = None
    source: str | None = None

    def validate(self, grain: str) -> None:
        given = [g for g in times.GRAINS if getattr(self, g) is not None]
        if given != list(times.GRAINS[: len(given)]):
            raise ValueError(f"a filter on {given[-1]} needs all that comes before it")
        if given and times.GRAINS.index(given[-1]) > times.GRAINS.index(grain):
            raise ValueError(f"a filter on {given[-1]} is finer than partitions by {grain}")
        if given and self.since_ms is not None:
            raise ValueError("a fixed and a rolling filter exclude each other")

    def condition(self, grain: str) -> Column:
        """Over partition columns alone, so that it decides which directories are read."""
        self.validate(grain)
        found = F.lit(True)
        if self.source is not None:
            found = found & (F.col("source") == self.source)
        for g in times.GRAINS:
            if getattr(self, g) is not None:
                found = found & (F.col(g).cast("int") == getattr(self, g))
        return found if self.since_ms is None else found & (partition_end(grain) > self.since_ms)


def partition_end(grain: str) -> Column:
    """Milliseconds at the end of the partition that the columns year to grain name."""
    have = times.GRAINS[: times.GRAINS.index(grain) + 1]
    part = {g: (F.col(g).cast("int") if g in have else F.lit(1 if g in ("month", "day") else 0)) for g in times.GRAINS}
    day = F.make_date(part["year"], part["month"], part["day"])
    if grain in ("year", "month"):
        return F.unix_date(F.add_months(day, 12 if grain == "year" else 1)).cast("long") * 86_400_000
    start = F.unix_date(day).cast("long") * 86_400_000 + part["hour"] * 3_600_000 + part["minute"] * 60_000
    return start + {"day": 86_400_000, "hour": 3_600_000, "minute": 60_000}[grain]


def parse_paths(files: DataFrame) -> DataFrame:
    """Adds source, year, month, day, hour and minute of a column path; null where a path doesn't say."""
    part = lambda n: F.nullif(F.regexp_extract("path", PATH, n), F.lit(""))
    return files.select("*", part(1).alias("source"), *[part(n + 2).cast("int").alias(g) for n, g in enumerate(times.GRAINS)])


def new_partitions(files: DataFrame, keys: list[str], cutoff_ms: int | None) -> DataFrame:
    """Partitions with a file changed after the cutoff, or at an unknown time (files: keys, mtime_ms); without a cutoff all."""
    seen = files.groupBy(*keys).agg(F.max("mtime_ms").alias("newest"), F.bool_or(F.col("mtime_ms").isNull()).alias("unknown"), F.count("*").alias("files"))
    return seen if cutoff_ms is None else seen.where(F.col("unknown") | (F.col("newest") > cutoff_ms))


def watermark(files: DataFrame, previous_ms: int | None) -> DataFrame:
    """One row: the state to save after a run over these files."""
    return files.agg(F.greatest(F.max("mtime_ms"), F.lit(previous_ms).cast("long")).alias("watermark_ms"))


def cutoff(watermark_ms: int) -> int:
    return max(0, watermark_ms - LAP_MS)


def not_completed(files: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Files that the manifest doesn't list with the same keys."""
    return files.join(manifest.select(*keys), keys, "left_anti")


def load_state(spark: SparkSession, path: str) -> int | None:
    """The latest watermark saved at ``path``; None on a first run. Rows that can't be read, as after a broken write, don't count."""
    try:
        rows = spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.select(F.from_json("value", "watermark_ms long")["watermark_ms"].alias("ms")).agg(F.max("ms")).first()[0]


def save_state(spark: SparkSession, path: str, watermark_ms: int) -> None:
    """Adds a state beside the earlier ones, so that a crash in between loses none."""
    spark.createDataFrame([(json.dumps({"version": 1, "watermark_ms": watermark_ms}),)], "value string").coalesce(1).write.mode("append").text(path)


def write_partitioned(rows: DataFrame, path: str, grain: str = "day", order: tuple[str, ...] = ("ts_ms",), level: int = 3, max_rows: int = 0) -> None:
    """Appends rows with ts_ms as zstd Parquet in year=/month=/... directories, sorted in each file.

    Rows are dealt by partition with a rebalancing exchange, which splits partitions that are large and joins
    small ones, so that a day of a hundred times the usual traffic isn't one task's.
    """
    rows, names = in_partitions(rows, grain)
    dealt(rows, names, order).write.mode("append").options(**zstd(level, max_rows), **blooms(rows, names)).partitionBy(*names).parquet(path)


def in_partitions(rows: DataFrame, grain: str) -> tuple[DataFrame, list[str]]:
    """The rows with the partition columns of their ts_ms, and these columns' names, source before them if there is one."""
    columns = times.partition_columns(F.col("ts_ms"), grain)
    return rows.select("*", *columns), (["source"] if "source" in rows.columns else []) + list(times.GRAINS[: len(columns)])


def dealt(rows: DataFrame, names: list[str], order: tuple[str, ...]) -> DataFrame:
    return rows.hint("rebalance", *[F.col(n) for n in names]).sortWithinPartitions(*names, *order)


def zstd(level: int, max_rows: int = 0) -> dict[str, str]:
    return {"compression": "zstd", "parquet.compression.codec.zstd.level": str(level), "maxRecordsPerFile": str(max_rows)}


def blooms(rows: DataFrame, names: list[str]) -> dict[str, str]:
    """Writer options for Bloom filters of the columns that searches name, but for partition columns."""
    wanted = ("mmsi", "station", "source", "imo_number", "call_sign", "name")
    return {f"parquet.bloom.filter.enabled#{name}": "true" for name in wanted if name in rows.columns and name not in names}


def replace_partitions(rows: DataFrame, path: str, keys: list[str], order: tuple[str, ...], level: int = 5) -> None:
    """Writes rows that have partition columns ``keys``; partitions that they are of are replaced as a whole, all others stay."""
    write = dealt(rows, keys, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.options(**zstd(level), **blooms(rows, keys)).partitionBy(*keys).parquet(path)


def write_bronze(rows: DataFrame, path: str, grain: str = "day", level: int = 5, max_rows: int = 0) -> None:
    """Appends source, ts_ms, file, line and payload as ts (milliseconds), file, line and payload, sorted by time, file and line.

    Times and payloads hardly repeat, so they are delta-encoded, without dictionaries; files repeat for long runs.
    """
    rows, names = in_partitions(rows, grain)
    told = dealt(rows, names, ("ts_ms", "file", "line")).select(F.timestamp_millis("ts_ms").alias("ts"), "file", "line", "payload", *names)
    plain = {f"parquet.enable.dictionary#{name}": "false" for name in ("ts", "line", "payload")}
    key = "spark.sql.parquet.outputTimestampType"
    before = rows.sparkSession.conf.get(key)
    rows.sparkSession.conf.set(key, "TIMESTAMP_MILLIS")
    try:
        told.write.mode("append").options(**zstd(level, max_rows), **{"parquet.writer.version": "v2"}, **plain).partitionBy(*names).parquet(path)
    finally:
        rows.sparkSession.conf.set(key, before)


#: All Parquet files but those whose names begin with "tmp-", which aren't finished.
FINISHED = "{[!t]*,t,t[!m]*,tm,tm[!p]*,tmp,tmp[!-]*}.parquet"


def read_partitioned(spark: SparkSession, roots: list[str], grain: str = "day", only: PartitionFilter | None = None) -> DataFrame:
    """One table of all roots; the filter is over partition columns, so that other directories aren't read."""
    rows = None
    for root in roots:
        one = spark.read.option("pathGlobFilter", FINISHED).option("recursiveFileLookup", "false").parquet(root)
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return rows.where((only or PartitionFilter()).condition(grain))


def listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, mtime_ms, source and the partition of each file under the roots; no file is opened."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", FINISHED)
    return parse_paths(read.load(roots).select("path", F.unix_millis("modificationTime").alias("mtime_ms")))


def dry_run(files: DataFrame, keys: list[str]) -> DataFrame:
    """Files of each partition that a run would read."""
    return files.groupBy(*keys).agg(F.countDistinct("path").alias("files"))
