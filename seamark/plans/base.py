"""Registration of queries with their SQL, and the inputs that they derive from the given tables.

The tables hold no AIS data, so sentences and feed messages are written from their integers. The SQL twin of a
query computes its result from the same integers, without ever decoding anything.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions import times
from seamark.functions.settle import settled
from seamark.operators import encode

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Year of arrival times in queries.
ETA_YEAR = 2024


class Tables:
    """The Parquet tables of a directory, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of Tables under its name, with its SQL if it has any."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def scratch(t: Tables, name: str) -> str:
    """A new folder for a query's own files in the shared folder; where none is named, one of this machine if all of Spark runs here."""
    root = t.spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", t.spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}"
    return f"{root.rstrip('/')}/seamark/{name}-{uuid.uuid4().hex}"


#: Common table expression with the integers of ``sightings``.
EV = """ev as (
  select event_id, user_id, event_type, value, ts, epoch_us(ts) // 1000 as ts_ms, 200000000 + user_id as mmsi,
         (event_id * 7919) % 216000000 - 108000000 as lon_raw, (event_id * 104729) % 108000000 - 54000000 as lat_raw,
         cast(floor(value) as bigint) % 1023 as sog_raw, event_id % 3600 as cog_raw,
         case when event_id % 10 = 0 then 511 else event_id % 360 end as heading_raw, event_id % 16 as nav_raw,
         event_id % 256 - 128 as rot_raw, event_id % 2 as acc_raw, event_id % 4 as man_raw, (event_id // 3) % 2 as raim_raw
  from events)"""


def sightings(t: Tables) -> DataFrame:
    """Each event as the integers of a ship's report."""
    e = F.col("event_id")
    return t.events.select(
        "event_id", "user_id", "event_type", "value", "ts", times.millis("ts").alias("ts_ms"), (F.col("user_id") + 200000000).alias("mmsi"),
        (e * 7919 % 216000000 - 108000000).alias("lon_raw"), (e * 104729 % 108000000 - 54000000).alias("lat_raw"),
        (F.floor("value") % 1023).cast("long").alias("sog_raw"), (e % 3600).alias("cog_raw"),
        F.when(e % 10 == 0, 511).otherwise(e % 360).cast("long").alias("heading_raw"), (e % 16).alias("nav_raw"),
        (e % 256 - 128).alias("rot_raw"), (e % 2).alias("acc_raw"), (e % 4).alias("man_raw"), (F.expr("event_id div 3") % 2).alias("raim_raw"),
    )


def c(name: str) -> Column:
    return F.col(name)


def position_fields(msg_type: int = 1) -> list:
    return [(msg_type, 6), (0, 2), (c("mmsi"), 30), (c("nav_raw"), 4), (c("rot_raw"), 8), (c("sog_raw"), 10), (c("acc_raw"), 1), (c("lon_raw"), 28), (c("lat_raw"), 27), (c("cog_raw"), 12), (c("heading_raw"), 9), (0, 6), (c("man_raw"), 2), (0, 3), (c("raim_raw"), 1), (0, 19)]


def class_b_fields() -> list:
    return [(18, 6), (0, 2), (c("mmsi"), 30), (0, 8), (c("sog_raw"), 10), (c("acc_raw"), 1), (c("lon_raw"), 28), (c("lat_raw"), 27), (c("cog_raw"), 12), (c("heading_raw"), 9), (0, 14), (c("raim_raw"), 1), (0, 20)]


def base_fields() -> list:
    return [(4, 6), (0, 2), (c("mmsi"), 30), (2024, 14), (1, 4), (1, 5), (0, 5), (0, 6), (0, 6), (c("acc_raw"), 1), (c("lon_raw"), 28), (c("lat_raw"), 27), (0, 14), (c("raim_raw"), 1), (0, 19)]


def sar_fields() -> list:
    return [(9, 6), (0, 2), (c("mmsi"), 30), (c("event_id") % 4096, 12), (c("sog_raw"), 10), (c("acc_raw"), 1), (c("lon_raw"), 28), (c("lat_raw"), 27), (c("cog_raw"), 12), (0, 19), (c("raim_raw"), 1), (0, 20)]


def binary_fields() -> list:
    return [(8, 6), (0, 2), (c("mmsi"), 30), (0, 2), (1, 10), (22, 6), (c("event_id") % 65536, 16), (c("user_id") % 256, 8)]


def safety_fields() -> list:
    return [(14, 6), (0, 2), (c("mmsi"), 30), (0, 2), (c("event_type"), -8)]


def aton_fields() -> list:
    return [(21, 6), (0, 2), (c("mmsi"), 30), (c("event_id") % 32, 5), (F.concat(F.lit("BUOY "), c("event_id").cast("string")), -20), (0, 1), (c("lon_raw"), 28), (c("lat_raw"), 27), (c("event_id") % 512, 9), (c("event_id") % 511, 9), (c("event_id") % 64, 6), (c("event_id") % 63, 6), (0, 4), (0, 6), (c("acc_raw"), 1), (0, 8), (c("raim_raw"), 1), (c("man_raw") % 2, 1), (c("acc_raw"), 1), (0, 1)]


def static_fields(name: Column, call_sign: Column, destination: Column, code: Column) -> list:
    """Type 5 from a number ``code``, which gives its other fields."""
    return [
        (5, 6), (0, 2), (200000000 + code, 30), (0, 2), (code % 9999999, 30), (call_sign, -7), (name, -20), (code % 100, 8), (code % 512, 9), (code % 511, 9), (code % 64, 6), (code % 63, 6),
        (0, 4), (code % 13, 4), (code % 29, 5), (code % 25, 5), (code % 61, 6), (code % 256, 8), (destination, -20), (0, 2),
    ]


#: Widths and values of the weather fields, from the same number; see ``layouts.METEO`` for their places.
METEO_31 = [(25, "lon_raw // 10"), (24, "lat_raw // 10"), (1, "event_id % 2"), (5, "event_id % 32"), (5, "event_id % 25"), (6, "event_id % 61"), (7, "event_id % 128"), (7, "(event_id + 3) % 128"), (9, "event_id % 361"), (9, "(event_id + 9) % 361"), (11, "event_id % 1200 - 600"), (7, "event_id % 102"), (10, "event_id % 700 - 200"), (9, "event_id % 403"), (2, "event_id % 4"), (1, "event_id % 2"), (7, "event_id % 128"), (12, "event_id % 4002"), (2, "event_id % 4"), (8, "event_id % 256"), (9, "event_id % 361"), (8, "(event_id + 1) % 256"), (9, "(event_id + 1) % 361"), (5, "event_id % 32"), (8, "(event_id + 2) % 256"), (9, "(event_id + 2) % 361"), (5, "(event_id + 1) % 32"), (8, "(event_id + 3) % 256"), (6, "event_id % 64"), (9, "(event_id + 3) % 361"), (8, "(event_id + 4) % 256"), (6, "(event_id + 1) % 64"), (9, "(event_id + 4) % 361"), (4, "event_id % 16"), (10, "event_id % 600 - 99"), (3, "event_id % 8"), (9, "event_id % 512"), (2, "event_id % 4"), (10, "0")]
METEO_11 = [(24, "lat_raw // 10"), (25, "lon_raw // 10"), (5, "event_id % 32"), (5, "event_id % 25"), (6, "event_id % 61"), (7, "event_id % 128"), (7, "(event_id + 3) % 128"), (9, "event_id % 512"), (9, "(event_id + 9) % 512"), (11, "event_id % 2048"), (7, "event_id % 128"), (10, "event_id % 1024"), (9, "event_id % 512"), (2, "event_id % 4"), (8, "event_id % 256"), (9, "event_id % 512"), (2, "event_id % 4"), (8, "event_id % 256"), (9, "event_id % 512"), (8, "(event_id + 1) % 256"), (9, "(event_id + 1) % 512"), (5, "event_id % 32"), (8, "(event_id + 2) % 256"), (9, "(event_id + 2) % 512"), (5, "(event_id + 1) % 32"), (8, "(event_id + 3) % 256"), (6, "event_id % 64"), (9, "(event_id + 3) % 512"), (8, "(event_id + 4) % 256"), (6, "(event_id + 1) % 64"), (9, "(event_id + 4) % 512"), (4, "event_id % 16"), (10, "event_id % 1024"), (3, "event_id % 8"), (9, "event_id % 512"), (2, "event_id % 4"), (6, "0")]


def meteo_fields(identifier: int) -> list:
    spelled = METEO_31 if identifier == 31 else METEO_11
    return [(8, 6), (0, 2), (c("mmsi"), 30), (0, 2), (1, 10), (identifier, 6), *[(F.expr(x.replace("//", "div")).cast("long"), width) for width, x in spelled]]


def mixed_lines(t: Tables) -> DataFrame:
    """One line an event, of a kind that event_id modulo 10 tells, with time, source and order."""
    kinds = [position_fields(1), position_fields(3), class_b_fields(), base_fields(), sar_fields(), binary_fields(), aton_fields(), safety_fields()]
    coded = [encode.message(fields) for fields in kinds]
    longest = max(width for _, width in coded)
    which = c("event_id") % 10
    bits, width = F.lit(""), F.lit(0)
    for k, (column, size) in enumerate(coded):
        bits, width = F.when(which == k, column).otherwise(bits), F.when(which == k, size).otherwise(width)
    station = F.concat(F.lit("STN"), (c("user_id") % 7).cast("string"))
    tagged = encode.tagged(c("payload"), station, F.expr("ts_ms div 1000"))
    written = settled(sightings(t), bits=bits, width=width, source=F.concat(F.lit("feed"), (c("user_id") % 3).cast("string")), line=c("event_id"))
    sealed = settled(written, payload=encode.armored_sentence(c("bits"), c("width"), longest)).drop("bits", "width")
    return settled(sealed, payload=F.when(which < 8, tagged).when(which == 8, "").otherwise("not a sentence at all"))


KIND_SQL = "case when event_id % 10 < 5 then 'position' when event_id % 10 = 5 then 'binary' when event_id % 10 = 6 then 'aton' when event_id % 10 = 7 then 'other' else 'failed' end"
TYPE_SQL = "case event_id % 10 when 0 then 1 when 1 then 3 when 2 then 18 when 3 then 4 when 4 then 9 when 5 then 8 when 6 then 21 when 7 then 14 end"
