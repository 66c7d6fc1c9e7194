"""Columns computed once, whatever uses them afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` by way of an array of one struct that is exploded.

    The optimizer copies the definition of a plain column into every filter and projection that uses it, and a
    parsed sentence is used by fifty fields; it doesn't copy what a generator makes. Generated code stays whole.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__made")
    kept = [n for n in df.columns if n not in columns]
    return df.select(*df.columns, made).select(*[F.col(f"`{n}`") for n in kept], *[F.col(f"__made.{n}").alias(n) for n in columns])
