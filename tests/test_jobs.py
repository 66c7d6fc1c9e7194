"""The ingest and decode jobs from files to tables, and their settings."""

import gzip
import json
import os

import pyarrow.parquet as pq
import pytest

from seamark.jobs import config, decode, ingest

PART_1 = "!AIVDM,2,1,3,B,55P5TL01VIaAL@7WKO@mBplU@<PDhh000000001S;AJ::4A80?4i@E53,0*3E"
PART_2 = "!AIVDM,2,2,3,B,1@0000000000000,2*55"
POSITION = "!AIVDM,1,1,,A,15RTgt0PAso;90TKcjM8h6g208CQ,0*4A"
CAPTURED = "$PGHP,1,2013,1,9,4,37,45,298,,110,,1,26*19"
DAY_1, DAY_2 = 1_700_000_000, 1_700_100_000  # 2023-11-14 and 2023-11-16


def put(folder, name, lines, at):
    folder.mkdir(parents=True, exist_ok=True)
    data = "".join(f"{line}\n" for line in lines).encode()
    (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    os.utime(folder / name, (at, at))


def rows(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


def test_files_to_tables(spark, tmp_path):
    raw, bronze, out = (f"file://{tmp_path}/{n}" for n in ("raw", "bronze", "out"))
    put(tmp_path / "raw", "x[1] a.txt", [PART_1, POSITION, PART_2, "", "junk", "y" * 70_000], DAY_1)
    put(tmp_path / "raw", "b.gz", [POSITION, CAPTURED, POSITION], DAY_2)
    taken = config.load(config.IngestConfig, {"input_dir": (raw,), "output_dir": bronze}, {})
    assert ingest.run(spark, taken) == {"files": 2, "lines_in": 9, "lines_out": 7}
    assert ingest.run(spark, taken) == {"files": 0, "lines_in": 0, "lines_out": 0}
    [file] = (tmp_path / "bronze").glob("source=b/year=2023/month=11/day=16/*.parquet")
    told = pq.ParquetFile(file)
    parts = {c.path_in_schema: c for c in (told.metadata.row_group(0).column(i) for i in range(4))}
    assert parts["ts"].encodings == ("DELTA_BINARY_PACKED",) and parts["ts"].compression == "ZSTD"
    assert not parts["payload"].has_dictionary_page and all(e.startswith("DELTA") for e in parts["payload"].encodings if e != "RLE")
    assert str(told.schema_arrow.field("ts").type) == "timestamp[ms, tz=UTC]"

    given = {"input_dir": (bronze,), "output_dir": out, "incremental": True, "consolidate_ais": True, "process_timestamps": True}
    run = config.load(config.DecodeConfig, given, {})
    dry = config.load(config.DecodeConfig, given | {"dry_run": True}, {})
    assert decode.run(spark, dry) == {"partitions": 2, "files": 2} and not (tmp_path / "out").exists()
    first = decode.run(spark, run)
    # of b's positions the second takes its time from the captured line before it
    assert {k: first[k] for k in ("partitions", "rows_in", "positions_out", "statics_out", "failed", "rows_deduped")} == {"partitions": 2, "rows_in": 6, "positions_out": 3, "statics_out": 1, "failed": 2, "rows_deduped": 0}
    assert rows(spark, f"{out}/statics", "mmsi", "name", "source", "day") == [(369190000, "MT.MITCHELL", "x[1] a", 14)]
    positions = rows(spark, f"{out}/positions", "ts_ms", "source", "day")
    assert positions == [(1_357_706_265_298, "b", 16), (DAY_1 * 1000, "x[1] a", 14), (DAY_2 * 1000, "b", 16)]

    # a later file changes one partition, which is replaced as a whole; the other is left alone
    for old in (tmp_path / "bronze").glob("source=*/year=*/month=*/day=*/*.parquet"):
        os.utime(old, (DAY_2, DAY_2))
    kept = set((tmp_path / "out/statics").rglob("*.parquet"))
    put(tmp_path / "raw", "c.txt", [POSITION], DAY_2)
    assert ingest.run(spark, taken) == {"files": 1, "lines_in": 1, "lines_out": 1}
    second = decode.run(spark, run)
    assert (second["partitions"], second["positions_out"], second["rows_deduped"]) == (1, 2, 1)
    assert rows(spark, f"{out}/positions", "ts_ms", "source", "day") == positions and set((tmp_path / "out/statics").rglob("*.parquet")) == kept
    for old in (tmp_path / "bronze").glob("source=*/year=*/month=*/day=*/*.parquet"):
        os.utime(old, (DAY_2, DAY_2))
    assert decode.run(spark, run) == {"partitions": 0}


def test_filters_and_feed(spark, tmp_path):
    bronze, out = f"file://{tmp_path}/bronze", f"file://{tmp_path}/out"
    body = {"MessageID": 1, "UserID": 5, "Latitude": 1.5, "Longitude": 2.5, "PositionAccuracy": True, "Raim": False}
    message = json.dumps({"MessageType": "PositionReport", "MetaData": {"MMSI": 5}, "Message": {"PositionReport": body}})
    for at, name in ((DAY_1, "a"), (DAY_2, "b")):
        put(tmp_path / "raw", f"{name}.txt", [message, "{}"], at)
    ingest.run(spark, config.IngestConfig((f"file://{tmp_path}/raw",), bronze))
    base = {"input_dir": (bronze,), "output_dir": out, "feed": "json"}
    found = decode.run(spark, config.load(config.DecodeConfig, base | {"year": 2023, "month": 11, "day": 14}, {}))
    assert (found["partitions"], found["rows_in"], found["positions_out"], found["failed"]) == (1, 2, 1, 1)
    assert rows(spark, f"{out}/positions", "mmsi", "source") == [(5, "a")]
    since = config.load(config.DecodeConfig, base | {"since": 24, "dry_run": True}, {})
    assert decode.run(spark, since, DAY_2 * 1000) == {"partitions": 1, "files": 1}
    only = config.load(config.DecodeConfig, base | {"filter_source": "b", "dry_run": True}, {})
    assert decode.run(spark, only) == {"partitions": 1, "files": 1}


def test_settings(tmp_path):
    file = tmp_path / "job.toml"
    file.write_text('INPUT_DIR = ["a", "b"]\nOUTPUT_DIR = "from-file"\nCOMPRESSION_LEVEL = 3\nCONSOLIDATE_AIS = true\nSINCE = 5\n')
    environ = {"CONFIG_FILE": str(file), "OUTPUT_DIR": "from-environment", "COMPRESSION_LEVEL": "7", "PROCESS_TIMESTAMPS": "off", "YEAR": ""}
    got = config.load(config.DecodeConfig, {"compression_level": 9}, environ)
    assert (got.input_dir, got.output_dir, got.compression_level, got.since) == (("a", "b"), "from-environment", 9, 5)
    assert got.consolidate_ais and not got.process_timestamps and got.year is None and got.partition == "day"
    base = {"input_dir": ("a",), "output_dir": "o"}
    for bad in ({"input_dir": ()}, {"partition": "week"}, {"incremental": True, "year": 2024}, {"month": 2}, {"year": 2024, "month": 13}, {"year": 2024, "since": 3}, {"feed": "json", "consolidate_ais": True}, {"compression_level": 0}, {"colour": 1}):
        with pytest.raises(ValueError):
            config.load(config.DecodeConfig, base | bad, {})
    with pytest.raises(ValueError):
        config.load(config.DecodeConfig, {"input_dir": ("a",)}, {})
    file.write_text("[table]\nOUTPUT_DIR = 1\n")
    with pytest.raises(ValueError):
        config.load(config.IngestConfig, {"input_dir": ("a",)}, {"CONFIG_FILE": str(file)})
