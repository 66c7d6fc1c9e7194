"""Row-level dedup: of rows with equal keys in one time partition, the first stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions import times

#: What tells the rows of each table apart besides time and mmsi. Sources aren't told apart, nor the two parts of a static report.
KEYS = {"positions": ("msg_type",), "statics": (), "meteo": ("dac", "fid"), "binary": ("dac", "fid"), "atons": ("msg_type",)}


def dedup(rows: DataFrame, table: str, order: tuple[str, ...], grain: str = "day", within: tuple[str, ...] = ()) -> DataFrame:
    """Keeps the first row, by ``order``, of each key; ``other`` keeps all. Partitions are those of ts_ms, or what columns ``within`` say."""
    if table not in KEYS:
        return rows
    part = within or (times.period_start(F.col("ts_ms"), grain),)
    key = Window.partitionBy(*part, "ts_ms", "mmsi", *KEYS[table]).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(key)).where("__place = 1").drop("__place")


def dedup_stream(rows: DataFrame, table: str, delay: str = "10 minutes") -> DataFrame:
    """The same for a stream with an event-time column ts: the first to arrive within the delay stays."""
    if table not in KEYS:
        return rows
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["ts", "mmsi", *KEYS[table]])
