"""Typed tables in Spark's catalogue: made when they are missing, grown when rows bring new columns, and added to in their own types.

A table is ``[prefix_]base`` in a namespace, partitioned by the calendar columns of its rows. A row's columns are
cast to the table's types; one that doesn't fit fails the write. Columns that rows lack are null. Columns that a
table lacks are added to it, and are null in its earlier rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions import times
from seamark.operators import decode, partitions

TABLES = tuple(decode.KINDS)


def table_name(base: str, prefix: str | None = None, namespace: str | None = None) -> str:
    """The quoted name of a table."""
    names = [*(namespace.split(".") if namespace else []), f"{prefix}_{base}" if prefix else base]
    return ".".join(f"`{name.replace('`', '``')}`" for name in names)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def ensure(spark: SparkSession, name: str, rows: DataFrame, keys: list[str], location: str | None = None, provider: str = "parquet") -> None:
    """Makes the table, and its namespace, if they are missing, and adds the columns of ``rows`` that it lacks."""
    parent = name.rpartition(".")[0]
    if parent:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {parent}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in keys)
    own = ", ".join(f"{quoted(k)} {rows.schema[k].dataType.simpleString()}" for k in keys)
    parts = f" PARTITIONED BY ({', '.join(quoted(k) for k in keys)})" if keys else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}{', ' + own if own else ''}) USING {provider}{parts}{place}")
    there = {c.lower() for c in spark.table(name).columns}
    new = [f for f in rows.schema.fields if f.name.lower() not in there]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quoted(f.name)} {f.dataType.simpleString()}' for f in new)})")
        spark.catalog.refreshTable(name)


def fitted(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The table's columns in its order and types."""
    have = {c.lower(): c for c in rows.columns}
    return rows.select(*[(F.col(quoted(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def append(rows: DataFrame, name: str, grain: str = "day", order: tuple[str, ...] = ("ts_ms",), location: str | None = None, provider: str = "parquet") -> None:
    """Adds rows with ts_ms, or with calendar columns already, to the table. A grain of minutes counts as hours."""
    grain = "hour" if grain == "minute" else grain
    keys = list(times.GRAINS[: times.GRAINS.index(grain) + 1])
    placed = rows if set(keys) <= set(rows.columns) else partitions.in_partitions(rows, grain)[0]
    spark = rows.sparkSession
    ensure(spark, name, placed, keys, location, provider)
    partitions.dealt(fitted(placed, spark.table(name)), keys, order).write.insertInto(name)
