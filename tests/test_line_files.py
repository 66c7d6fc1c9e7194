"""Pieces of files against lines split in memory, the data source's partitions, and files that exceed what one row can hold."""

import bz2
import gzip
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from seamark.jobs import config, ingest
from seamark.sources import line_files as lf


def split(data, limit):
    """(place, line or None) of all lines."""
    out, at = [], 0
    for line in data.split(b"\n"):
        out.append((at, line if len(line) < limit else None))
        at += len(line) + 1
    return out[:-1] if data.endswith(b"\n") or not data else out


def random_data(rng, n):
    return b"".join(rng.choice([b"", b"a" * rng.randint(0, 30), "é日".encode(), b"x" * rng.randint(0, 400), b"\r"]) + b"\n" for _ in range(n)) + rng.choice([b"", b"tail"])


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_pieces_hold_every_line_once(tmp_path, monkeypatch, block):
    monkeypatch.setattr(lf, "BLOCK", block)
    rng = random.Random(block)
    for number, data in enumerate([b"", b"\n", b"a", b"a\n", b"\n\n", b"z" * 500, *(random_data(rng, 60) for _ in range(6))]):
        for name, pack in (("plain", bytes), ("gzip", gzip.compress), ("bzip2", bz2.compress)):
            path = tmp_path / f"{number}.{name}"
            path.write_bytes(pack(data))
            for size in (1, 13, 200, 1 << 20) if name == "plain" else (1,):
                found = [line for piece in lf.pieces_of(str(path), path.stat().st_size, 0, size) for places, lines in lf.framed(piece, 100) for line in zip(places.tolist(), lines, strict=True)]
                assert found == split(data, 100), (name, size, data)


def test_broken_archives_give_what_can_be_read(tmp_path):
    whole = gzip.compress(b"".join(b"line %d\n" % i for i in range(100_000)), 1)
    (tmp_path / "cut.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "bad.zip").write_bytes(b"PK nothing")
    [piece] = lf.pieces_of(str(tmp_path / "cut.gz"), 1, 0)
    lines = [x for _, some in lf.framed(piece) for x in some]
    assert 20_000 < len(lines) < 80_000 and lines[7] == b"line 7"
    assert lf.pieces_of(str(tmp_path / "bad.zip"), 1, 0) == []


def read(spark, path, **options):
    spark.dataSource.register(lf.LineFiles)
    return spark.read.format("seamark_lines").options(**options).load(path)


def test_entries_and_ranges_are_partitions(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(6):
            archive.writestr(f"part-{i}.txt", "".join(f"{i} {n}\n" for n in range(1000)))
    one = read(spark, f"file://{tmp_path}", split="4000")
    assert one.rdd.getNumPartitions() == 6
    assert {r["entry"]: r["n"] for r in one.groupBy("entry").agg(F.count("*").alias("n")).collect()} == {f"part-{i}.txt": 1000 for i in range(6)}
    assert read(spark, f"file://{tmp_path}").rdd.getNumPartitions() == 1
    (tmp_path / "large.txt").write_text("".join(f"row {n}\n" for n in range(20_000)))
    large = read(spark, f"file://{tmp_path}/large.txt", split="30000")
    assert large.rdd.getNumPartitions() > 5
    assert [r.payload for r in large.orderBy("line").collect()] == [f"row {n}" for n in range(20_000)]


def test_a_job_reads_files_larger_than_a_row_may_be(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "plain.txt").write_text("".join(f"plain {n}\n" for n in range(3000)))
    (raw / "packed.bin").write_bytes(gzip.compress(b"".join(b"packed %d\n" % n for n in range(3000))))
    with zipfile.ZipFile(raw / "a.zip", "w") as archive:
        archive.writestr("x.txt", "zip 1\n\nzip 2\n")
        archive.writestr("y.txt", "zip 3\r\n" + "y" * 70_000 + "\n")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 5)
    try:
        found = ingest.run(spark, config.IngestConfig((f"file://{raw}",), f"file://{tmp_path}/bronze"))
        assert found == {"files": 3, "lines_in": 6005, "lines_out": 6003}
        assert ingest.run(spark, config.IngestConfig((f"file://{raw}",), f"file://{tmp_path}/bronze"))["files"] == 0
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    rows = spark.read.parquet(f"file://{tmp_path}/bronze")
    assert {r.payload for r in rows.where("file like '%a.zip!%'").collect()} == {"zip 1", "zip 2", "zip 3"}
    assert [r.payload for r in rows.where("source = 'packed'").orderBy("line").collect()] == [f"packed {n}" for n in range(3000)]
