"""Feeds from servers on this machine: lines, dropped connections, frames, and a query that is stopped and started again."""

import base64
import hashlib
import socket
import struct
import threading
import time

import pytest

from seamark.sources import feeds, live


class Server:
    """Accepts one connection after another, each served by the next of ``scripts``."""

    def __init__(self, *scripts):
        self.listening = socket.create_server(("127.0.0.1", 0))
        self.port = self.listening.getsockname()[1]
        self.scripts, self.errors = list(scripts), []
        self.thread = threading.Thread(target=self.run, daemon=True)
        self.thread.start()

    def run(self):
        for script in self.scripts:
            connection, _ = self.listening.accept()
            try:
                script(connection)
            except Exception as error:  # noqa: BLE001  shown by the test
                self.errors.append(error)
            connection.close()


def gathered(listener, number, seconds=20):
    found, until = [], time.time() + seconds
    while len(found) < number and time.time() < until:
        found += [line for _, line in listener.take()]
        time.sleep(0.02)
    return found


def test_lines_of_a_limit():
    for cut in (1, 3, 1000):
        lines, data = feeds.Lines(10), b"ab\r\n\nlong" + b"x" * 30 + b"\ncd\n123456789\n1234567890\nrest"
        assert [x for at in range(0, len(data), cut) for x in lines.split(data[at : at + cut])] == [b"ab", b"cd", b"123456789"]


def test_a_dropped_connection_loses_no_later_line():
    def first(connection):
        connection.sendall(b"one\ntwo\nhal")

    def refused(connection):
        return

    def later(connection):
        connection.sendall(b"three\nfo")
        time.sleep(0.3)
        connection.sendall(b"ur\n")
        time.sleep(1)

    server = Server(first, refused, later)
    listener = live.Listener(feeds.TcpFeed("127.0.0.1", server.port), first_wait=0.05)
    listener.start()
    assert gathered(listener, 4) == [b"one", b"two", b"three", b"four"]
    listener.end()


def test_waits_double_and_begin_anew_after_data(monkeypatch):
    class Feed:
        calls = []

        def messages(self):
            self.calls.append(time.monotonic())
            if len(self.calls) == 4:
                yield [b"x"]
            raise OSError

    feed = Feed()
    listener = live.Listener(feed, first_wait=0.1)
    listener.start()
    time.sleep(1.6)
    listener.end()
    gaps = [b - a for a, b in zip(feed.calls[:-1], feed.calls[1:], strict=True)]
    assert gaps[0] < 0.18 < gaps[1] < 0.35 < gaps[2] and gaps[3] < 0.18


def test_a_full_list_makes_the_sender_wait():
    listener = live.Listener(feeds.TcpFeed("127.0.0.1", 1), largest=10)
    thread = threading.Thread(target=lambda: listener.hold([b"0123456789"]), daemon=True)
    thread.start()
    time.sleep(0.2)
    assert thread.is_alive()
    assert len(listener.take()) == 1
    thread.join(5)
    assert not thread.is_alive()


def greeted(connection):
    """Answers a client's greeting; its request."""
    request = b""
    while b"\r\n\r\n" not in request:
        request += connection.recv(1000)
    key = [line for line in request.split(b"\r\n") if line.lower().startswith(b"sec-websocket-key:")][0].split(b":")[1].strip()
    answer = base64.b64encode(hashlib.sha1(key + feeds.ACCEPT).digest())
    connection.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + answer + b"\r\n\r\n")
    return request


def sent(kind, payload, last=True):
    size = len(payload)
    return bytes([0x80 * last | kind]) + (bytes([size]) if size < 126 else struct.pack("!BH", 126, size) if size < 1 << 16 else struct.pack("!BQ", 127, size)) + payload


def received(connection):
    held = bytearray()
    while not (found := feeds.frame_at(held)):
        held += connection.recv(1000)
    return found[1:3]


def test_frames_of_all_kinds():
    told = []

    def script(connection):
        told.append(greeted(connection).split(b"\r\n")[0])
        told.append(received(connection))
        connection.sendall(sent(feeds.TEXT, b"a\nb\n") + sent(feeds.BINARY, b"c"))
        connection.sendall(sent(feeds.TEXT, b"be", False) + sent(feeds.PING, b"there?") + sent(feeds.CONTINUED, b"fo", False) + sent(feeds.CONTINUED, b"re"))
        told.append(received(connection))
        connection.sendall(sent(feeds.TEXT, b"y" * 300) + sent(feeds.TEXT, b"z" * 70_000)[:500])
        time.sleep(0.3)
        connection.sendall(sent(feeds.TEXT, b"z" * 70_000)[500:] + sent(feeds.TEXT, b"last") + sent(feeds.CLOSE, struct.pack("!H", 1000)))
        told.append(received(connection))

    def again(connection):
        greeted(connection)
        received(connection)
        connection.sendall(sent(feeds.TEXT, b"after"))
        time.sleep(1)

    def wrong(connection):
        connection.recv(1000)
        connection.sendall(b"HTTP/1.1 403 Forbidden\r\n\r\n")

    server = Server(script, wrong, again)
    listener = live.Listener(feeds.WebSocketFeed(f"ws://127.0.0.1:{server.port}/v0/stream?x=1", '{"APIKey": "k"}'), first_wait=0.05)
    listener.start()
    assert gathered(listener, 7) == [b"a", b"b", b"c", b"before", b"y" * 300, b"last", b"after"] and not server.errors
    assert told == [b"GET /v0/stream?x=1 HTTP/1.1", (feeds.TEXT, b'{"APIKey": "k"}'), (feeds.PONG, b"there?"), (feeds.CLOSE, struct.pack("!H", 1000))]
    listener.end()


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 125, 126, 70_000])
def test_masks(size):
    data = bytes(range(256)) * (size // 256 + 1)
    last, kind, payload, length = feeds.frame_at(bytearray(feeds.frame(feeds.TEXT, data[:size])))
    assert (last, kind, payload) == (True, feeds.TEXT, data[:size]) and length > size


def test_segments_are_planned_again_until_they_are_committed(tmp_path):
    reader = live.LiveReader(feeds.TcpFeed("127.0.0.1", 1), str(tmp_path / "kept"), "s")
    reader.listener = live.Listener(reader.feed)
    assert reader.initialOffset() == reader.latestOffset() == {"line": 0}
    reader.listener.hold([b"a", b"b"])
    one = reader.latestOffset()
    reader.listener.hold([b"c"])
    two = reader.latestOffset()
    rows = lambda low, high: [(r["line"], r["payload"]) for p in reader.partitions(low, high) for batch in reader.read(p) for r in batch.to_pylist()]
    assert rows({"line": 0}, two) == [(0, "a"), (1, "b"), (2, "c")] and rows(one, two) == [(2, "c")] and rows(two, two) == []
    reader.commit(one)
    again = live.LiveReader(reader.feed, str(tmp_path / "kept"), "s")
    assert again.partitions({"line": 0}, one) == [] and rows(one, two) == [(2, "c")] and again.next_number() == 3
    again.commit(two)
    assert again.next_number() == 3


def test_a_query_over_a_dropped_connection_and_a_restart(spark, tmp_path):
    def count(first, last):
        def script(connection):
            for n in range(first, last):
                connection.sendall(b"line %d\n" % n)
                time.sleep(0.01)
        return script

    spark.dataSource.register(live.TcpSource)
    out = f"{tmp_path}/out"

    def run(port, until):
        rows = spark.readStream.format("seamark_tcp").options(host="127.0.0.1", port=str(port), source="tcp", buffer=f"{tmp_path}/kept").load()
        query = rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/mark").trigger(processingTime="200 milliseconds").start(out)
        try:
            limit = time.time() + 90
            while time.time() < limit:
                if query.exception():
                    raise query.exception()
                if query.lastProgress and spark.read.schema("payload string").parquet(out).where(f"payload = 'line {until}'").count():
                    break
                time.sleep(0.5)
        finally:
            query.stop()

    run(Server(count(0, 50), count(50, 100)).port, 99)
    run(Server(count(100, 150)).port, 149)
    rows = spark.read.parquet(out).orderBy("line").collect()
    assert [r.payload for r in rows] == [f"line {n}" for n in range(150)] and {r.source for r in rows} == {"tcp"}
    assert [r.line for r in rows] == list(range(150))
