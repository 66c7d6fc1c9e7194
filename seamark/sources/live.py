"""Streams of feeds that can't be asked again: lines are kept in a folder until a batch with them is committed.

``spark.readStream.format("seamark_tcp")`` and ``"seamark_websocket"``. A thread beside the driver reads the feed, joins it
again after an error or an end, waiting 1 second and twice as long after each attempt that fails, up to 60, and holds what
came until the next batch is planned. Then it is written as a segment, one Parquet file named by the numbers of its first line and the one
after its last, and only then offered to Spark; numbers are the offsets. Tasks read segments from the folder, a batch is
planned again from the same ones after a failure, and they go when a later batch is committed. So a line that arrived
before a batch was planned is in exactly one batch; what the feed says while nobody listens is lost, as are the lines
that are held when the driver dies. A thread that holds ``largest`` bytes stops reading, so that the sender waits.

The folder (option ``buffer``) is one that the driver and all executors share. Options: host and port, or url and
subscription; source (its name in rows), maxLineLength.
"""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from seamark.sources.feeds import TcpFeed, WebSocketFeed
from seamark.sources.line_files import MAX_LINE_BYTES, store

LINES = "source string, line long, arrival_ms long, payload string"
FIRST_WAIT, LAST_WAIT = 1.0, 60.0
HELD_BYTES = 64 << 20
#: Lines of a segment that share a task.
TASK_LINES = 200_000


class Listener(threading.Thread):
    """Reads a feed, for ever, into a list."""

    def __init__(self, feed: TcpFeed | WebSocketFeed, first_wait: float = FIRST_WAIT, largest: int = HELD_BYTES):
        super().__init__(daemon=True)
        self.feed, self.first_wait, self.largest = feed, first_wait, largest
        self.lines: list[tuple[int, bytes]] = []
        self.size, self.connections, self.ended = 0, 0, False
        self.free = threading.Condition()

    def run(self) -> None:
        wait = self.first_wait
        while not self.ended:
            try:
                for some in self.feed.messages():
                    if self.ended:
                        return
                    if some is not None:
                        wait = self.first_wait
                        self.hold(some)
            except OSError:
                pass
            deadline = time.monotonic() + wait
            while not self.ended and time.monotonic() < deadline:
                time.sleep(min(0.05, wait))
            wait = min(2 * wait, LAST_WAIT)

    def hold(self, some: list[bytes]) -> None:
        now = int(time.time() * 1000)
        with self.free:
            self.lines += [(now, line) for line in some]
            self.size += sum(map(len, some))
            while self.size >= self.largest and not self.ended:
                self.free.wait(0.1)

    def take(self) -> list[tuple[int, bytes]]:
        with self.free:
            lines, self.lines, self.size = self.lines, [], 0
            self.free.notify()
        return lines

    def end(self) -> None:
        self.ended = True


class Segments:
    """The segments of a folder, by their first and last numbers."""

    def __init__(self, folder: str):
        self.system, self.folder = store(folder)

    def path(self, first: int, after: int) -> str:
        return f"{self.folder.rstrip('/')}/{first:020d}-{after:020d}.parquet"

    def list(self) -> list[tuple[int, int]]:
        found = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        named = (re.fullmatch(r"(\d{20})-(\d{20})\.parquet", f.base_name) for f in found)
        return sorted((int(m[1]), int(m[2])) for m in named if m)

    def write(self, first: int, lines: list[tuple[int, bytes]]) -> None:
        self.system.create_dir(self.folder, recursive=True)
        arrival, payload = zip(*lines, strict=True)
        table = pa.table({"arrival_ms": pa.array(arrival, pa.int64()), "payload": pa.array([x.decode("utf-8", "replace") for x in payload], pa.string())})
        path = self.path(first, first + len(lines))
        pq.write_table(table, f"{path}.part", filesystem=self.system, compression="zstd")
        self.system.move(f"{path}.part", path)

    def drop(self, upto: int) -> None:
        """Segments that end before ``upto`` go; the last one stays, since it tells the next number."""
        for first, after in self.list()[:-1]:
            if after <= upto:
                self.system.delete_file(self.path(first, after))


class Part(InputPartition):
    """Lines ``begin`` to ``end`` of the segment first-after."""

    def __init__(self, first: int, after: int, begin: int, end: int):
        super().__init__(None)
        self.first, self.after, self.begin, self.end = first, after, begin, end


class LiveReader(DataSourceStreamReader):
    def __init__(self, feed: TcpFeed | WebSocketFeed, folder: str, source: str):
        self.feed, self.folder, self.source = feed, folder, source
        self.listener: Listener | None = None

    def __getstate__(self) -> dict:
        return vars(self) | {"listener": None}  # tasks read segments only

    def initialOffset(self) -> dict:
        return {"line": self.next_number()}

    def next_number(self) -> int:
        return max((after for _, after in Segments(self.folder).list()), default=0)

    def latestOffset(self) -> dict:
        if self.listener is None:
            self.listener = Listener(self.feed)
            self.listener.start()
        first, lines = self.next_number(), self.listener.take()
        if lines:
            Segments(self.folder).write(first, lines)
        return {"line": first + len(lines)}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        low, high = start["line"], end["line"]
        parts = []
        for first, after in Segments(self.folder).list():
            for begin in range(max(first, low), min(after, high), TASK_LINES):
                parts.append(Part(first, after, begin, min(begin + TASK_LINES, after, high)))
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        segments = Segments(self.folder)
        table = pq.read_table(segments.path(partition.first, partition.after), filesystem=segments.system)
        table = table.slice(partition.begin - partition.first, partition.end - partition.begin)
        numbers = pa.array(range(partition.begin, partition.end), pa.int64())
        whole = pa.table({"source": pa.repeat(pa.scalar(self.source), len(table)), "line": numbers, "arrival_ms": table["arrival_ms"], "payload": table["payload"]})
        yield from whole.to_batches()

    def commit(self, end: dict) -> None:
        Segments(self.folder).drop(end["line"])

    def stop(self) -> None:
        if self.listener is not None:
            self.listener.end()


class LiveSource(DataSource):
    def schema(self) -> str:
        return LINES

    def feed(self) -> TcpFeed | WebSocketFeed:
        raise NotImplementedError

    def streamReader(self, schema) -> LiveReader:
        if "buffer" not in self.options:
            raise ValueError("option buffer is a folder that the driver and all executors share")
        return LiveReader(self.feed(), self.options["buffer"], self.options.get("source", "default"))


class TcpSource(LiveSource):
    @classmethod
    def name(cls) -> str:
        return "seamark_tcp"

    def feed(self) -> TcpFeed:
        return TcpFeed(self.options["host"], int(self.options["port"]), int(self.options.get("maxlinelength", MAX_LINE_BYTES)))


class WebSocketSource(LiveSource):
    @classmethod
    def name(cls) -> str:
        return "seamark_websocket"

    def feed(self) -> WebSocketFeed:
        return WebSocketFeed(self.options["url"], self.options.get("subscription", ""), int(self.options.get("maxlinelength", MAX_LINE_BYTES)))
