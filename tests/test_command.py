"""The jobs from a shell, and a feed brought into bronze tables that the decode job reads."""

import json
import socket
import threading
import time

import pytest

from seamark import __main__ as command
from seamark.jobs import config, listen
from tests.test_jobs import DAY_1, POSITION, put


def test_flags_variables_and_files(tmp_path):
    (tmp_path / "c.toml").write_text('PARTITION = "hour"\nMAX_ROWS = 9\n')
    words = ["ingest", "--input-dir", "a,b", "--output-dir", "o", "--config", str(tmp_path / "c.toml")]
    got = command.settings(command.parser().parse_args(words), {"MAX_ROWS": "7", "OUTPUT_DIR": "no"})
    assert (got.input_dir, got.output_dir, got.partition, got.max_rows) == (("a", "b"), "o", "hour", 7)
    decoded = command.settings(command.parser().parse_args(["decode", "--input-dir", "b", "--output-dir", "o", "--incremental", "--h3", "off"]), {})
    assert decoded.incremental and not decoded.h3


def test_exit_codes(spark, tmp_path, capsys):
    put(tmp_path / "raw", "a.txt", [POSITION, "junk"], DAY_1)
    words = ["ingest", "--input-dir", f"file://{tmp_path}/raw", "--output-dir", f"file://{tmp_path}/bronze"]
    assert command.main(words, spark, {}) == 0
    assert json.loads(capsys.readouterr().out) == {"files": 1, "lines_in": 2, "lines_out": 2}
    assert command.main(words, spark, {}) == command.NOTHING
    assert command.main(["ingest", "--input-dir", "x", "--partition", "week"], spark, {}) == 1 and "partition" in capsys.readouterr().err
    assert command.main(["health", "--status-file", str(tmp_path / "none")]) == 1


@pytest.mark.parametrize("wrong", [{"feed": "carrier"}, {"feed": "tcp", "tcp_host": "x"}, {"feed": "websocket"}, {"feed": "kafka", "kafka_brokers": "b"}, {"feed": "websocket", "websocket_url": "ws://x", "bounding_boxes": "[[1, 2]]"}])
def test_feeds_that_lack_settings(wrong):
    with pytest.raises(ValueError):
        config.ListenConfig(**wrong).validate()


def test_a_tcp_feed_becomes_tables(spark, tmp_path):
    listening = socket.create_server(("127.0.0.1", 0))

    def serve():
        connection, _ = listening.accept()
        for _ in range(30):
            connection.sendall(f"{POSITION}\n".encode())
            time.sleep(0.02)
        time.sleep(30)

    threading.Thread(target=serve, daemon=True).start()
    bronze, out, state = f"file://{tmp_path}/bronze", f"file://{tmp_path}/out", str(tmp_path / "status.json")
    words = ["listen", "--feed", "tcp", "--tcp-host", "127.0.0.1", "--tcp-port", str(listening.getsockname()[1]), "--output-dir", bronze, "--seconds", "1", "--status-file", state]
    settings = command.settings(command.parser().parse_args(words), {})
    query, listener = listen.start(spark, settings)
    try:
        limit = time.time() + 90
        while time.time() < limit and sum(p.numInputRows for p in query.recentProgress) < 30:
            assert query.exception() is None
            time.sleep(0.5)
        assert command.main(["health", "--status-file", state]) == 0
    finally:
        query.stop()
        spark.streams.removeListener(listener)
    assert spark.read.parquet(bronze).count() == 30
    assert command.main(["decode", "--input-dir", bronze, "--output-dir", out], spark, {}) == 0
    assert {r.mmsi for r in spark.read.parquet(f"{out}/positions").select("mmsi").collect()} == {371798000}
