"""Connected components of a graph too large for one machine, by alternating star joins.

Large-star: each node ties its larger neighbours to the smallest node that it sees. Small-star: each
node ties its smaller neighbours, and itself, to the smallest of them. Alternating both ends with one
star around the smallest node of each component. Minima are pre-aggregated before each shuffle, so
the centre of a large star is one row a task; the join on it is an ordinary one that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.storage import materialize


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("high", "low").union(edges.select(F.col("low"), F.col("high"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    tied = both.join(least, "node").where(F.col("other") > F.col("node"))
    return tied.select(F.col("other").alias("high"), F.least("least", "node").alias("low")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    lower = edges.join(least, "high").where(F.col("low") > F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low"))
    return lower.union(least.select("high", F.col("least").alias("low"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component, the smallest node reachable; nodes that are smallest themselves are left out."""
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    while True:
        now = materialize(small_star(large_star(now)), "stars")
        ends = now.select("high").distinct()
        stars = ends.count() == now.count() and now.join(ends.select(F.col("high").alias("low")), "low", "left_semi").isEmpty()
        if stars:
            return now.select(F.col("high").alias("node"), F.col("low").alias("component"))
