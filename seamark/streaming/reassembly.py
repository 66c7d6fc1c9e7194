"""Fragments of a stream of lines put together with keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seamark.operators import ordering, slots

PART = "struct<number:int,armor:string,fill:string,text:string,line:bigint>"
STATE = f"line long, ts_ms long, tags string, start string, channel string, count int, parts array<{PART}>"
OUT = "source string, line long, ts_ms long, body string, tags string, raw string"


def fragment_stream(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole lines as they are, and fragments with the columns that the rule of ``slots`` reads, and their time as ts."""
    found = ordering.fragments(lines)
    whole = found.where("group is null").select("source", "line", "ts_ms", "payload", F.lit(True).alias("complete"))
    return whole, found.where("group is not null").select("source", "group", *ordering.FRAGMENT, F.timestamp_millis("ts_ms").alias("ts"))


def told(put: DataFrame) -> DataFrame:
    payload = ordering.sealed(F.col("body"), F.col("tags"), F.col("raw"))
    return put.select("source", "line", "ts_ms", payload.alias("payload"), F.col("body").isNotNull().alias("complete"))


def frame(source: str, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(source, *row) for row in rows], columns=["source", *slots.OUT])


def fragment_rows(batch: pd.DataFrame) -> list[dict]:
    """The rows in the order of their lines, with nulls as None."""
    batch = batch.sort_values("line")
    return batch.astype(object).where(batch.notna(), None).to_dict("records")


def packed(held: slots.Open) -> tuple:
    return held.line, held.ts_ms, held.tags, held.start, held.channel, held.count, [(n, *part) for n, part in held.parts.items()]


def unpacked(state: tuple) -> slots.Open:
    return slots.Open(*state[:6], {n: tuple(part) for n, *part in state[6]})


def reassemble_stream(lines: DataFrame, late: str = "1 day", timeout_ms: int = slots.TIMEOUT_MS) -> DataFrame:
    """source, line, ts_ms, payload and complete, as ``ordering.reassemble`` gives them for the same lines.

    Time is that of the lines: a message is given up when the watermark, which lies ``late`` behind the latest line, has
    passed its time by ``timeout_ms``, or when a fragment so late comes for it. Whole lines are never late.
    """
    whole, parts = fragment_stream(lines)

    def gather(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = unpacked(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield frame(key[0], held.given_up())
            return
        out = []
        for batch in batches:
            for row in fragment_rows(batch):
                held, some = slots.take(held, row, timeout_ms)
                out += some
        if held is not None:
            state.update(packed(held))
            state.setTimeoutTimestamp(max(held.ts_ms, state.getCurrentWatermarkMs()) + timeout_ms)
        elif state.exists:
            state.remove()
        yield frame(key[0], out)

    put = parts.withWatermark("ts", late).groupBy("source", "group").applyInPandasWithState(gather, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return whole.unionByName(told(put))
