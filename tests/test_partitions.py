"""Partition filters, state, sinks and line sources."""

import bz2
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from seamark.operators import partitions
from seamark.sources import lines


def test_filter_rules():
    partitions.PartitionFilter(year=2024, month=2).validate("day")
    for bad, grain in ((dict(month=2), "day"), (dict(year=2024, month=2, day=3, hour=4), "day"), (dict(year=2024, since_ms=5), "day")):
        with pytest.raises(ValueError):
            partitions.PartitionFilter(**bad).validate(grain)


def test_since_keeps_partitions_that_end_later(spark):
    days = spark.createDataFrame([("2026", "07", d) for d in ("03", "04", "05")], "year string, month string, day string")
    cut = 1783166400000  # 2026-07-04 12:00
    kept = days.where(partitions.PartitionFilter(since_ms=cut).condition("day")).collect()
    assert sorted(r.day for r in kept) == ["04", "05"]


def test_reads_all_but_unfinished_files(spark, tmp_path):
    for at, name in enumerate(("t.parquet", "test-0.parquet", "tm.parquet", "tmp.parquet", "a.parquet", "tmp-1.parquet")):
        folder = tmp_path / "root/year=2024/month=01/day=02"
        spark.range(at, at + 1).coalesce(1).write.mode("overwrite").parquet(f"file://{tmp_path}/one")
        folder.mkdir(parents=True, exist_ok=True)
        next((tmp_path / "one").glob("part-*.parquet")).rename(folder / name)
    assert sorted(r.id for r in partitions.read_partitioned(spark, [f"file://{tmp_path}/root"]).collect()) == [0, 1, 2, 3, 4]


def test_new_partitions(spark):
    rows = [("a", 100), ("a", 300), ("b", 100), ("b", 200), ("c", 100), ("c", None)]
    files = spark.createDataFrame(rows, "day string, mtime_ms long")
    assert sorted(r.day for r in partitions.new_partitions(files, ["day"], 200).collect()) == ["a", "c"]


def test_state(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    assert partitions.load_state(spark, path) is None
    partitions.save_state(spark, path, 1_000_000)
    assert partitions.cutoff(partitions.load_state(spark, path)) == 995_000
    partitions.save_state(spark, path, 2_000_000)
    assert partitions.load_state(spark, path) == 2_000_000
    (tmp_path / "state/part-broken.txt").write_text('{"version": 1, "watermark_ms": 9')
    assert partitions.load_state(spark, path) == 2_000_000
    (tmp_path / "bad").write_text("{")
    assert partitions.load_state(spark, f"file://{tmp_path}/bad") is None


def test_written_partitions_are_pruned(spark, tmp_path):
    rows = spark.range(0, 3000).select((F.col("id") * 3_600_000).alias("ts_ms"), F.col("id").alias("mmsi"))
    path = f"file://{tmp_path}/out"
    partitions.write_partitioned(rows, path)
    assert (tmp_path / "out/year=1970/month=01/day=02").exists()
    only = partitions.read_partitioned(spark, [path], "day", partitions.PartitionFilter(year=1970, month=1, day=2))
    assert only.count() == 24
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_formats_by_first_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_text("plain-1\nplain-2\n")
    (tmp_path / "b.dat").write_bytes(gzip.compress(b"gzip-1\n"))
    (tmp_path / "c.dat").write_bytes(bz2.compress(b"bzip-1\n"))
    (tmp_path / ".hidden").write_text("no\n")
    (tmp_path / "d.tar").write_text("no\n")
    (tmp_path / "e.tar.gz").write_bytes(gzip.compress(b"gzip-2\n"))
    (tmp_path / "f.gz").write_bytes(b"\x1f\x8bbroken")
    with zipfile.ZipFile(tmp_path / "g.zip", "w") as z:
        z.writestr("x.txt", "zip-1\n")
        z.writestr(".skip", "no\n")
        z.writestr("d/y.txt", "zip-2\n" + "x" * 70000 + "\n")
    got = lines.scan_any(spark, f"file://{tmp_path}").orderBy("payload").collect()
    assert [r.payload for r in got] == ["bzip-1", "gzip-1", "gzip-2", "plain-1", "plain-2", "zip-1", "zip-2"]
    assert {r.source for r in got} == {"a", "b", "c", "e.tar", "g"}


def test_long_message_is_dropped_whole(spark):
    df = spark.createDataFrame([(1, "a\nb\n\nc"), (2, "a\n" + "x" * 50)], "id long, value string")
    assert [(r.id, r.payload) for r in lines.message_lines(df, 40).orderBy("line").collect()] == [(1, "a"), (1, "b"), (1, "c")]
