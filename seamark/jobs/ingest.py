"""Files of lines to time-partitioned bronze tables, each file once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seamark.jobs.config import IngestConfig
from seamark.operators import partitions
from seamark.sources import line_files, lines

FILE_KEY = ["path", "size", "mtime_ms"]
MANIFEST, PENDING = "_completed", "_pending"


def manifest(spark: SparkSession, output_dir: str) -> DataFrame:
    """The files that earlier runs completed: path, size, mtime_ms."""
    schema = "path string, size long, mtime_ms long"
    try:
        return spark.read.schema(schema).parquet(f"{output_dir}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run(spark: SparkSession, config: IngestConfig) -> dict[str, int]:
    """Adds the lines of all files that no earlier run completed, and then the files to the manifest.

    Returns the numbers of files, lines read and lines written; lines of ``max_line_length`` bytes or more and empty ones
    aren't written. A file that changed is read again. The list of new files is a table of its own, which tasks cut into
    pieces and which joins the manifest at the end; none of it passes through the driver but Spark's listing itself. A run
    that fails before its manifest is written has completed no file, so the next one reads them all again: lines come at
    least once.
    """
    config.validate()
    path = f"{config.output_dir}/{PENDING}"
    found = lines.listed(spark, list(config.input_dir))
    partitions.not_completed(found, manifest(spark, config.output_dir), FILE_KEY).write.mode("overwrite").parquet(path)
    new = spark.read.schema(found.schema).parquet(path)
    files, size = new.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not files:
        return {"files": 0, "lines_in": 0, "lines_out": 0}
    read, written = Observation("read"), Observation("written")
    tasks = max(1, -(-(size + files * line_files.OPENING) // line_files.SPLIT))
    cut = line_files.dealt(line_files.pieces(new.repartition(min(tasks, files))), tasks)
    told = line_files.read_pieces(cut, config.max_line_length).observe(read, F.count("*").alias("n"))
    told = told.where("payload != ''").observe(written, F.count("*").alias("n"))
    if config.source is not None:
        told = told.withColumn("source", F.lit(config.source))
    file = F.when(F.col("entry") == "", F.col("file")).otherwise(F.concat("file", F.lit("!"), "entry"))
    rows = told.select("source", F.col("arrival_ms").alias("ts_ms"), file.alias("file"), "line", "payload")
    partitions.write_bronze(rows, config.output_dir, config.partition, config.compression_level, config.max_rows or 0)
    new.write.mode("append").parquet(f"{config.output_dir}/{MANIFEST}")
    return {"files": files, "lines_in": read.get["n"], "lines_out": written.get["n"]}
