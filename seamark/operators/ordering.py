"""Operators over the order of lines: timestamps carried forward, and sentences put together from fragments.

Lines need source, line (their order in it), arrival_ms and payload.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from seamark.functions import sentences
from seamark.functions.settle import settled
from seamark.operators import slots

#: What the rule of ``slots`` reads of a fragment.
FRAGMENT = ("line", "ts_ms", "tags", "start", "channel", "count", "number", "armor", "fill", "text")


def resolve_timestamps(lines: DataFrame) -> DataFrame:
    """Adds ts_ms: the line's own tag time, else the time pending from lines before it, else its arrival.

    A capture line sets the pending time, as does a fragment with a tag time; a fragment without one leaves it
    unless it is its message's last; every other line clears it. Nothing is carried from one file to the next, if
    lines have a column file. What a line does doesn't depend on the pending
    time before it, so the last line that did anything decides, and one window finds it.
    """
    text = sentences.sentence(F.col("payload"))
    parsed = settled(settled(lines, __text=text), **parts(F.col("__text")))
    captured, own = F.col("__capture"), F.col("__own")
    fragment = F.coalesce(F.col("__count") > 1, F.lit(False))
    last = F.coalesce(F.col("__number") == F.col("__count"), F.lit(False))
    keeps = F.col("__ais") & fragment & ~last & own.isNull()
    sets = F.when(captured.isNotNull(), captured).when(F.col("__ais") & fragment, own)
    after = F.when(captured.isNull() & keeps, F.lit(None)).otherwise(F.struct(sets.alias("value")))
    session = [c for c in ("source", "file") if c in lines.columns]
    before = Window.partitionBy(*session).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    pending = F.last(after, ignorenulls=True).over(before)["value"]
    ts = F.coalesce(captured, F.when(F.col("__ais"), F.coalesce(own, pending)), F.col("arrival_ms"))
    return parsed.withColumn("ts_ms", ts).drop(*[c for c in parsed.columns if c.startswith("__")])


def parts(text: Column) -> dict[str, Column]:
    return {
        "__capture": sentences.capture_ms(text), "__own": sentences.tag_seconds_ms(sentences.prefix(F.col("payload"))), "__ais": sentences.is_ais(text),
        "__count": sentences.fragment_count(text), "__number": sentences.fragment_number(text),
    }


def places(rows: DataFrame, bucket: Column, *order: str) -> DataFrame:
    """Adds place, the row's number from 1 in ``order``, of which ``bucket`` is a coarser key of bounded range, nulls first.

    Rows are numbered within their buckets, and only the buckets' counts in one task.
    """
    cut = rows.withColumn("__bucket", bucket)
    upto = F.sum("__count").over(Window.orderBy(F.col("__bucket").asc_nulls_first()))
    bases = cut.groupBy("__bucket").agg(F.count("*").alias("__count")).select(F.col("__bucket").alias("__key"), (upto - F.col("__count")).alias("__base"))
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    numbered = cut.withColumn("__within", within).join(bases, F.col("__bucket").eqNullSafe(F.col("__key")))
    return numbered.select(*rows.columns, (F.col("__base") + F.col("__within")).alias("place"))


def fragments(lines: DataFrame) -> DataFrame:
    """Adds group, count, number, armor, fill, start, channel and tags of fragmented lines; group is null for all others."""
    text = sentences.sentence(F.col("payload"))
    cut, text = settled(lines, text=text), F.col("text")
    before = sentences.prefix(F.col("payload"))
    station = sentences.tag_field(F.regexp_replace(before, r"\\", ""), "s")
    seconds = sentences.tag_seconds_ms(before)
    found = settled(
        cut, group=sentences.fragment_group(text), count=sentences.fragment_count(text), number=F.coalesce(sentences.fragment_number(text), F.lit(1)),
        armor=F.get(F.split(text, ","), F.lit(5)), fill=sentences.field(text, 6), start=sentences.field(text, 0), channel=sentences.field(text, 4), seconds=seconds, station=station,
    )
    told = F.concat_ws(",", F.when(F.col("seconds").isNotNull(), F.concat(F.lit("c:"), F.expr("seconds div 1000"))), F.when(F.col("station").isNotNull(), F.concat(F.lit("s:"), "station")))
    return found.withColumn("tags", told).drop("seconds", "station")


def stretches(found: DataFrame, keys: list[str], timeout_ms: int) -> DataFrame:
    """Numbers the stretches of each group: a fragment whose time lies over ``timeout_ms`` after all before it meets no open message."""
    order = Window.partitionBy(*keys).orderBy("line")
    latest = F.max("ts_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = found.withColumn("__cut", F.coalesce(F.col("ts_ms") - latest > timeout_ms, F.lit(False)).cast("int"))
    return cut.withColumn("stretch", F.sum("__cut").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__cut")


def sealed(body: Column, tags: Column, raw: Column) -> Column:
    """A joined sentence with its checksum, and before it a tag block with its own if there are tags; or a fragment as it is."""
    whole = sentences.closed(body, "!")
    tagged = F.when(tags == "", whole).otherwise(F.concat(F.lit("\\"), tags, F.lit("*"), sentences.checksum(tags), F.lit("\\"), whole))
    return F.when(body.isNull(), raw).otherwise(tagged)


def reassemble(lines: DataFrame, session: tuple[str, ...] = ("source",), timeout_ms: int = slots.TIMEOUT_MS) -> DataFrame:
    """The columns of ``session``, line (of the first fragment to come), ts_ms, payload and complete.

    Lines with source, line, ts_ms and payload; whole lines pass as they are. Fragments of one message have equal
    columns ``session``, in which lines are in the order of line, and go into slots by the rule of ``slots``. A message
    whose fragments all came is one sentence with the time and tags of the first to come; others pass fragment by fragment.
    A task reads its groups in order and holds one open message, so no group is gathered, however long.
    """
    found = fragments(lines)
    whole = found.where("group is null").select(*session, "line", "ts_ms", "payload", F.lit(True).alias("complete"))
    keys = [*session, "group"]
    parts = stretches(found.where("group is not null"), keys, timeout_ms).select(*keys, "stretch", *FRAGMENT)
    dealt = parts.repartition(*keys, "stretch").sortWithinPartitions(*keys, "stretch", "line")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in (*keys, "stretch"))
                if key != now:
                    out += [(*now[: len(session)], *x) for x in held.given_up()] if held else []
                    now, held = key, None
                held, some = slots.take(held, row, timeout_ms)
                out += [(*key[: len(session)], *x) for x in some]
            yield arrow_rows(out)
        if held:
            yield arrow_rows([(*now[: len(session)], *x) for x in held.given_up()])

    schema = T.StructType([*(parts.schema[k] for k in session), *(T.StructField(n, T.LongType() if n in ("line", "ts_ms") else T.StringType()) for n in slots.OUT)])

    def arrow_rows(rows: list[tuple]) -> pa.RecordBatch:
        names = [*session, *slots.OUT]
        kinds = [arrow_types[n] for n in names]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=names)

    arrow_types = {f.name: f.type for f in to_arrow_schema(schema)}
    put = dealt.mapInArrow(fold, schema)
    told = put.select(*session, "line", "ts_ms", sealed(F.col("body"), F.col("tags"), F.col("raw")).alias("payload"), F.col("body").isNotNull().alias("complete"))
    return whole.unionByName(told)
