"""Reassembly of a stream with a bound on open messages: a source that has ``most`` of them gives up its oldest for a new one.

State is by source, since the bound is. The oldest message comes out joined from the fragments that it has. Other
than that, messages are put together and given up as by ``reassembly.reassemble_stream``, whose state is by group and
spreads a busy source over tasks; there memory is bounded by time alone. Needs the RocksDB state store.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seamark.operators import slots
from seamark.streaming.reassembly import OUT, fragment_rows, fragment_stream, frame, packed, told, unpacked

#: Open messages of a source.
MOST = 8192
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Reassembler(StatefulProcessor):
    def __init__(self, most: int, timeout_ms: int):
        self.most, self.timeout_ms = most, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.open = handle, handle.getMapState("open", "group string", "message string")

    def held(self) -> dict[str, slots.Open]:
        return {group[0]: unpacked(json.loads(message[0])) for group, message in self.open.iterator()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        held, out, changed = self.held(), [], set()
        ages = [(m.ts_ms, m.line, group) for group, m in held.items()]
        heapq.heapify(ages)
        for row in fragment_rows(pd.concat(list(rows))):  # a source's fragments of one micro-batch
            group = row["group"]
            now, some = slots.take(held.get(group), row, self.timeout_ms)
            if now is not None and group not in held and len(held) >= self.most:
                while (oldest := heapq.heappop(ages))[2] not in held or (held[oldest[2]].ts_ms, held[oldest[2]].line) != oldest[:2]:
                    pass  # an entry of a message that is no longer open
                out += held.pop(oldest[2]).joined()
                changed.add(oldest[2])
            out += some
            changed.add(group)
            if now is None:
                held.pop(group, None)
            else:
                if held.get(group) is not now:
                    heapq.heappush(ages, (now.ts_ms, now.line, group))
                held[group] = now
        self.save(held, changed)
        yield frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.held()
        late = sorted((m.line, group) for group, m in held.items() if m.ts_ms + self.timeout_ms <= timerValues.getCurrentWatermarkInMs())
        out = [x for _, group in late for x in held.pop(group).given_up()]
        self.save(held, {group for _, group in late})
        yield frame(key[0], out)

    def save(self, held: dict[str, slots.Open], changed: set[str]) -> None:
        """The messages that changed, and a timer for the oldest of all."""
        for group in changed:
            if group in held:
                self.open.updateValue((group,), (json.dumps(packed(held[group])),))
            elif self.open.containsKey((group,)):
                self.open.removeKey((group,))
        due = min((m.ts_ms for m in held.values()), default=None)
        timers = [t for t in self.handle.listTimers()]
        for timer in timers:
            self.handle.deleteTimer(timer)
        if due is not None:
            self.handle.registerTimer(due + self.timeout_ms)

    def close(self) -> None:
        pass


def state_store(spark: SparkSession) -> None:
    """Sets the state store that such state needs, for queries that start from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def reassemble_bounded(lines: DataFrame, most: int = MOST, late: str = "1 day", timeout_ms: int = slots.TIMEOUT_MS) -> DataFrame:
    """source, line, ts_ms, payload and complete."""
    state_store(lines.sparkSession)
    whole, parts = fragment_stream(lines)
    put = parts.withWatermark("ts", late).groupBy("source").transformWithStateInPandas(Reassembler(most, timeout_ms), OUT, "Append", "EventTime")
    return whole.unionByName(told(put))
