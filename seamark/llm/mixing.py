"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Each source gets a target of words: its weight's share of the mix, at most ``cap`` times its size,
with the excess shared anew by weight (a water level, found with one pass over the sources sorted by
how soon they fill). Within a source, document i gets the rate r_i = cap / (1 + (cap - 1) exp(-l x_i)),
the exponential tilt of the rate 1 that stays under the cap; x_i is its size as a share of the
source's largest. The dual variable l is the root of sum(size_i r_i) = target, found by Newton steps.
They run on a histogram of (source, size), since documents of equal size share a rate; starting
from logit(target / cap) every step moves towards the root and none beyond it.

Rates become copies in the histogram too: cumulative sums over sizes are rounded, then the words
still missing or over are settled from the largest size that fits downwards. Copies are dealt to the
documents of a cell by doc_id in salted buckets, so neither a hot source nor a hot size meets in one task.

Null text: size 0, taken 0. A null source is a source of its own, ordered last. Repeated rows count
as often as they come. Empty input gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to rows (source, source_key, source_size, largest); one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    fill = (F.col("source_size") * cap / F.col("weight")).alias("fill")
    ranked = weighed.withColumn("full", F.col("source_size") * float(cap)).withColumn("fill", fill)
    soonest = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = soonest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    words = F.sum("source_size").over(everything) * share
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (words - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / open_weight
    levels = ranked.withColumn("level", level).withColumn("place", F.row_number().over(soonest))
    # the first source, by fill, that the water doesn't fill gives the level of all that come after
    first = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("place", "level"))).over(everything)
    return levels.withColumn("water", first["level"]).withColumn("target", F.coalesce(F.least("full", F.col("weight") * F.col("water")), "full")).drop("level", "place", "water", "weight", "fill")


def rate(dual: Column, size: Column, largest: Column, cap: float) -> Column:
    """Null dual: the target takes all that the cap allows."""
    x = size / F.greatest(largest, F.lit(1))
    return F.coalesce(F.lit(float(cap)) / (1 + (cap - 1) * F.exp(-dual * x)), F.lit(float(cap)))


def solve_dual(cells: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-7, rounds: int = 12) -> DataFrame:
    """Adds ``dual`` to the sources; each round is three distributed Newton steps over the histogram."""
    part = F.col("target") / F.col("full")
    start = F.when((part > 0) & (part < 1), F.log(part / (1 - part)) + F.log(F.lit(cap - 1.0)))
    solved = sources.withColumn("dual", F.when(part <= 0, F.lit(float("-inf"))).otherwise(start)).withColumn("miss", F.lit(None).cast("double"))
    for n in range(rounds):
        for _ in range(3):
            x = F.col("size") / F.greatest("largest", F.lit(1))
            r = rate(F.col("dual"), F.col("size"), F.col("largest"), cap)
            tokens = F.col("n") * F.col("size")
            seen = cells.join(solved.select("source_key", "largest", "dual"), "source_key").groupBy("source_key").agg(F.sum(tokens * r).alias("mixed"), F.sum(tokens * x * r * (1 - r / cap)).alias("slope"))
            step = F.when(F.col("slope") > 0, (F.col("mixed") - F.col("target")) / F.col("slope")).otherwise(F.lit(0.0))
            solved = solved.join(seen, "source_key", "left").withColumn("miss", F.abs(F.col("mixed") - F.col("target")) / F.greatest("target", F.lit(1.0))).withColumn("dual", F.col("dual") - F.coalesce(step, F.lit(0.0))).drop("mixed", "slope")
        solved = materialize(solved, f"dual{n}")
        worst = solved.where("dual is not null and target < full").agg(F.max("miss")).first()[0]
        if worst is None or worst < tolerance:
            break
    return solved


def cell_copies(cells: DataFrame, sources: DataFrame, cap: int, passes: int = 5) -> DataFrame:
    """Whole copies for each (source, size): columns source_key, size, n, copies."""
    rated = cells.join(sources.select("source_key", "largest", "dual", "target"), "source_key").withColumn("expected", F.col("n") * rate(F.col("dual"), F.col("size"), F.col("largest"), cap))
    source = Window.partitionBy("source_key")
    downwards = source.orderBy(F.col("size").desc())
    upto, before = downwards.rowsBetween(Window.unboundedPreceding, 0), downwards.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("expected").over(upto)
    whole = (F.round(total) - F.round(total - F.col("expected"))).cast("long")
    dealt = rated.withColumn("copies", F.least(F.greatest(whole, F.lit(0)), F.col("n") * cap))
    for _ in range(passes):
        dealt = dealt.withColumn("error", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source))
        room = F.when(F.col("error") > 0, F.col("n") * cap - F.col("copies")).otherwise(F.col("copies"))
        dealt = dealt.withColumn("room", F.when((F.col("size") > 0) & (F.col("size") <= F.abs("error")), room).otherwise(F.lit(0)))
        left = F.abs("error") - F.coalesce(F.sum(F.col("room") * F.col("size")).over(before), F.lit(0))
        change = F.least("room", F.greatest(F.lit(0), F.floor(left / F.greatest("size", F.lit(1)))))
        dealt = dealt.withColumn("copies", F.col("copies") + F.when(F.col("error") > 0, change).otherwise(-change)).drop("error", "room")
    return dealt.select("source_key", "size", "n", F.col("copies").cast("long").alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: int = 2, row: str | None = None) -> DataFrame:
    """Per row: doc_id, size, source_size, target, copies, taken; and the column ``row``, if one is named, to join by."""
    carry = [F.col(row).alias("row_id")] if row else [F.lit(0).alias("row_id")]
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(docs.select(*carry, "doc_id", "source", key.alias("source_key"), size.alias("size")), "sizes")
    cells = materialize(sized.groupBy("source_key", "size").agg(F.count("*").alias("n")), "cells")
    named = F.when(F.col("source_key") != "", F.substring("source_key", 2, 1 << 30)).alias("source")
    sources = cells.groupBy("source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.max("size").alias("largest")).select("*", named)
    sources = solve_dual(cells, materialize(source_targets(sources, weights, share, float(cap)), "targets"), float(cap))
    plan = materialize(cell_copies(cells, sources, cap), "copies")
    buckets = max(16, sized.count() // 1_000_000)
    salted = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    cell = Window.partitionBy("source_key", "size").orderBy("bucket")
    share_of = salted.groupBy("source_key", "size", "bucket").agg(F.count("*").alias("here")).join(plan, ["source_key", "size"])
    each = F.expr("copies div n")
    upto = F.sum("here").over(cell)
    # of the copies beyond a whole number for each, a bucket gets its share
    extra = lambda seen: F.floor((F.col("copies") - F.col("each") * F.col("n")) * seen / F.col("n"))
    dealt = share_of.withColumn("each", each).withColumn("upto", upto).select("source_key", "size", "bucket", "each", (extra(F.col("upto")) - extra(F.col("upto") - F.col("here"))).alias("more"))
    order = Window.partitionBy("source_key", "size", "bucket").orderBy("doc_id", "row_id")
    ranked = salted.withColumn("place", F.row_number().over(order)).join(dealt, ["source_key", "size", "bucket"])
    copies = (F.col("each") + F.when(F.col("place") <= F.col("more"), 1).otherwise(0)).cast("long")
    told = ranked.withColumn("copies", copies).join(sources.select("source_key", "source_size", "target"), "source_key")
    return told.select(*(["row_id"] if row else []), "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
