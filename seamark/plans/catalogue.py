"""The registered queries of the AIS engine and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seamark.operators import decode, dedup
from seamark.plans import base, decode_queries, json_queries, ordered_queries, partition_queries, text_queries

MODULES = (text_queries, decode_queries, ordered_queries, partition_queries, json_queries)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all kinds, decoded; positions without repetitions."""
    parsed = decode.parse(base.mixed_lines(base.Tables(spark, sf_dir)))
    return dedup.dedup(decode.positions(parsed), "positions", ("source", "line"))


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
