"""Reassembly over a file stream, stopped and started again in the middle of a message."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from seamark.jobs import config, decode
from seamark.operators import ordering
from seamark.streaming import bounded, reassembly, status, tables
from tests.test_ordering import as_lines, shuffled_fragments

PART_1 = "!AIVDM,2,1,3,B,55P5TL01VIaAL@7WKO@mBplU@<PDhh000000001S;AJ::4A80?4i@E53,0*3E"
PART_2 = "!AIVDM,2,2,3,B,1@0000000000000,2*55"
POSITION = "!AIVDM,1,1,,A,15RTgt0PAso;90TKcjM8h6g208CQ,0*4A"
SCHEMA = "source string, line long, ts_ms long, payload string"


def test_reused_sequence_id_and_timeout(spark, tmp_path):
    source, out = (f"file://{tmp_path}/{n}" for n in ("in", "out"))
    rows = [("x", 1, 1_700_000_000_000, PART_1), ("x", 2, 1_700_000_000_500, PART_1), ("x", 3, 1_700_000_001_000, PART_2), ("y", 4, 1_700_000_000_000, PART_1), ("w", 7, 1_700_000_000_000, PART_2), ("w", 8, 1_700_000_000_000, PART_1)]
    for at, some in enumerate([rows, [("z", 5, 1_700_000_000_000 + 3 * 86_400_000, POSITION)], [("z", 6, 1_700_000_000_000 + 4 * 86_400_000, PART_1)]]):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        found = reassembly.reassemble_stream(spark.readStream.schema(SCHEMA).parquet(source), late="1 second", timeout_ms=1000)
        found.writeStream.format("parquet").option("checkpointLocation", f"{out}-mark").trigger(availableNow=True).start(out).awaitTermination(120)
    got = [(r.source, r.line, r.payload if not r.complete else None, r.complete) for r in spark.read.parquet(out).collect()]
    # the second of x's first fragments finds its slot taken
    assert ("x", 1, None, True) in got and ("y", 4, PART_1, False) in got
    assert ("w", 7, None, True) in got and ("z", 5, None, True) in got and len(got) == 4


def test_restart_between_fragments(spark, tmp_path):
    source, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def run():
        query = tables.run_tables(spark.readStream.schema(SCHEMA).parquet(source), out, mark, "feed", 2024)
        query.awaitTermination(120)

    add([("x", 1, 1_700_000_000_000, PART_1), ("x", 2, 1_700_000_000_000, POSITION)])
    run()
    assert spark.read.parquet(f"{out}/positions").count() == 1
    assert not (tmp_path / "out/statics").exists()
    add([("x", 3, 1_700_000_001_000, PART_2)])
    run()
    [row] = spark.read.parquet(f"{out}/statics").collect()
    assert (row.mmsi, row.name, row.ts_ms) == (369190000, "MT.MITCHELL", 1_700_000_000_000)


def streamed(spark, tmp_path, parts, how):
    """What a stream gives that reads ``parts`` one after the other, each by a query of its own that ends."""
    source, out = (f"file://{tmp_path}/{n}" for n in ("in", "out"))
    for some in parts:
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        found = how(spark.readStream.schema(SCHEMA).parquet(source))
        found.writeStream.format("parquet").option("checkpointLocation", f"{out}-mark").trigger(availableNow=True).start(out).awaitTermination(120)
    return sorted((r.source, r.line, r.ts_ms, r.payload, r.complete) for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("how", [reassembly.reassemble_stream, bounded.reassemble_bounded])
def test_streams_give_what_a_batch_gives(spark, tmp_path, how):
    lines = as_lines(shuffled_fragments(11))
    end = [("zz", 10**6, lines[-1][2] + 3 * 86_400_000, POSITION)], [("zz", 10**6 + 1, lines[-1][2] + 4 * 86_400_000, PART_1), ("zz", 10**6 + 2, lines[-1][2] + 4 * 86_400_000, PART_2)]
    parts = [lines[:333], lines[333:600], lines[600:], *end, [("zz", 10**6 + 3, lines[-1][2] + 8 * 86_400_000, POSITION)]]
    got = [r for r in streamed(spark, tmp_path, parts, lambda s: how(s, late="1 second")) if r[0] != "zz"]
    batch = ordering.reassemble(spark.createDataFrame(lines, SCHEMA)).collect()
    assert got == sorted((r.source, r.line, r.ts_ms, r.payload, r.complete) for r in batch)


def test_the_oldest_open_message_makes_room(spark, tmp_path):
    """Three may be open; state stays over a restart, and a message that made room comes out joined from what it has."""
    line = lambda at, sid, number, armor: ("x", at, 1_700_000_000_000 + at, f"!AIVDM,3,{number},{sid},A,{armor},0*00")
    first = [line(1, 1, 1, "a1"), line(2, 1, 3, "a3"), line(3, 2, 1, "b1"), line(4, 3, 1, "c1")]
    second = [line(5, 3, 2, "c2"), line(6, 4, 1, "d1"), line(7, 5, 2, "e2"), line(8, 3, 3, "c3"), line(9, 6, 1, "f1"), line(10, 2, 2, "b2")]
    got = streamed(spark, tmp_path, [first, second], lambda s: bounded.reassemble_bounded(s, most=3))
    assert [(r[1], r[3].split(",")[5], r[4]) for r in got] == [(1, "a1a3", True), (3, "b1", True), (4, "c1c2c3", True), (6, "d1", True)]
    assert all(",1,1,,A," in r[3] for r in got)


def test_the_bound_of_sources(spark, tmp_path):
    rows = [("x", k, 1_700_000_000_000 + k, f"!AIVDM,2,1,{k},A,p{k},0*00") for k in range(bounded.MOST + 1)]
    got = streamed(spark, tmp_path, [rows], bounded.reassemble_bounded)
    assert [(r[1], r[3].split(",")[5]) for r in got] == [(0, "p0")]


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path, monkeypatch):
    source, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "out", "mark"))
    rows = [("x", 1, 1_700_000_000_000, PART_1), ("x", 2, 1_700_000_000_000, PART_2), ("x", 3, 1_700_000_000_000, POSITION), ("x", 4, 1_700_100_000_000, POSITION), ("x", 5, 1_600_000_000_000, POSITION)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    read = lambda: spark.readStream.schema(SCHEMA).parquet(source)
    note, fail = tables.Ledger.note, [True]

    def killed(self, batch, table):
        if table == "statics" and fail:  # positions are noted by then, statics written but not noted
            raise RuntimeError("killed")
        note(self, batch, table)

    monkeypatch.setattr(tables.Ledger, "note", killed)
    query = tables.run_tables(read(), out, mark, "feed", 2024)
    with pytest.raises(Exception, match="killed"):
        query.awaitTermination(120)
    assert spark.read.parquet(f"{out}/positions").count() == 3 and spark.read.parquet(f"{out}/statics").count() == 1
    written = set((tmp_path / "out/positions").rglob("*.parquet"))
    fail.clear()
    tables.run_tables(read(), out, mark, "feed", 2024).awaitTermination(120)
    assert spark.read.parquet(f"{out}/positions").count() == 3 and spark.read.parquet(f"{out}/statics").count() == 1
    assert set((tmp_path / "out/positions").rglob("*.parquet")) == written
    spark.createDataFrame([("x", 9, 1_700_000_000_000, POSITION.replace("15RT", "15RS"))], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    tables.run_tables(read(), out, mark, "feed", 2024).awaitTermination(120)
    assert spark.read.parquet(f"{out}/positions").count() == 4 and {r.day for r in spark.read.parquet(f"{out}/positions").select("day").distinct().collect()} == {13, 14, 16}


def test_lines_of_a_stream_become_bronze(spark, tmp_path):
    """Days come in any order over restarts, and the decode job reads what the stream wrote."""
    source, out, mark = (f"file://{tmp_path}/{n}" for n in ("in", "bronze", "mark"))
    schema = "source string, line long, arrival_ms long, payload string"
    rng, rows = random.Random(1), []
    for part in range(3):
        some = [("x", 100 * part + k, 1_700_000_000_000 + rng.randint(-3, 3) * 86_400_000, POSITION) for k in range(40)]
        rows += some
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(source)
        tables.run_bronze(spark.readStream.schema(schema).parquet(source), out, mark, "feed").awaitTermination(120)
    got = spark.read.parquet(out)
    assert sorted((r.line, r.ms) for r in got.select("line", F.unix_millis("ts").alias("ms")).collect()) == sorted((r[1], r[2]) for r in rows)
    assert got.where(F.to_date("ts") != F.make_date("year", "month", "day")).count() == 0
    found = decode.run(spark, config.DecodeConfig((out,), f"file://{tmp_path}/tables"))
    assert (found["rows_in"], found["positions_out"]) == (120, len({r[2] for r in rows}))


def test_status_of_queries(spark, tmp_path):
    path = str(tmp_path / "status.json")
    assert status.problems(path, 1000)[0].startswith("no status")
    listener = status.StatusListener(path)
    spark.streams.addListener(listener)
    try:
        spark.createDataFrame([("x", 1, 5, POSITION)] * 7, SCHEMA).write.parquet(f"{tmp_path}/in")
        rows = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in").observe("seen", F.count("*").alias("n"), F.max("line").alias("last"))
        rows.writeStream.queryName("good").format("noop").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination(60)
        limit = time.time() + 30
        while time.time() < limit and not any(q["state"] == "ended" for q in listener.queries.values()):
            time.sleep(0.2)
        [row] = listener.rows(spark).collect()
        assert (row["query"], row["state"], row["rows_total"], row["batch"]) == ("good", "ended", 7, 0) and row["observed"] == {"seen.n": "7", "seen.last": "1"}
        assert status.problems(path, 1000) == []
    finally:
        spark.streams.removeListener(listener)
    listener.change("other", query="slow")
    at = listener.queries["other"]["at_ms"]
    assert status.problems(path, 60_000, at + 59_000) == [] and status.problems(path, 60_000, at + 61_000) == ["slow has told nothing for 61 s"]
    listener.change("other", state="failed", error="broken")
    assert status.problems(path, 60_000, at) == ["slow failed: broken"] and json.load(open(path))["queries"][1]["state"] == "failed"
