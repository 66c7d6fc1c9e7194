"""Where intermediate tables go, so that lost executors cost no recomputed lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, a new one of this machine if all of Spark runs here."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/seamark/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders, wherever Spark can."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that are written within, so what was made of them must be written by then."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        delete(spark, made)


#: Bytes of a partition up to which a join may hold one side of it as a hash table, as measured when it runs.
HASHED = 64 << 20


def measured_hash_joins(spark: SparkSession) -> None:
    """Lets Spark take a hash join, which needn't sort the other side, where all partitions of a side were measured as small; elsewhere it sorts and may spill. A caller's own setting stays."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(key, "0") in ("0", "0b"):
        spark.conf.set(key, str(HASHED))


#: Bytes of an Arrow batch between Spark and Python. By default batches have ten thousand rows, whatever these hold, in the executor and in the worker.
BATCH = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches in bytes too. A caller's own setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and returns a reader of the files."""
    return written(df, new_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` as Parquet at ``path`` and returns a reader of the files."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Narrow rows (a number, and another or a flag) that each executor may hold: about 64 MB as a hash table.
SMALL_ROWS = 1 << 20


def small(table: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has ``SMALL_ROWS`` at most, so that texts that meet it aren't shuffled."""
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def row_numbers(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a number of each row that is the same whenever they are read.

    Rows that are read from Parquet files as they are have their file's number, in the order of paths, and their place in it; of the
    files one row each passes the driver. Other documents are written first.
    """
    spark = docs.sparkSession
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        path, place = free_name(docs, "__path"), free_name(docs, "__place")
        try:
            located = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
        except AnalysisException:
            located = None  # not Parquet, or a column of that name
        if located is not None:
            files = sorted(r[0] for r in located.select(path).distinct().collect())
            numbers = spark.createDataFrame(list(zip(files, range(len(files)), strict=True)), f"`{path}` string, __file long")
            return located.join(F.broadcast(numbers), path).select(*docs.columns, (F.shiftleft("__file", 36) + F.col(place)).alias(name))
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
