"""Files of lines, cut into pieces that tasks stream: ranges of plain files, whole compressed files, entries of zip archives.

Files are told by their first bytes, whatever their names; an archive's directory is read from its end. A piece is read in
blocks, so memory doesn't grow with a file, an archive or a line. ``pieces`` and ``read_pieces`` are steps over a table of
files; ``LineFiles`` is the same as a data source, ``spark.read.format("seamark_lines").load(folder)``, of which each
partition is a run of small pieces or one large one. Files are opened by Arrow: local ones, and s3, gs, abfs and hdfs stores.

A line's place is where it begins, in bytes of the file or entry after decompression. Lines of ``max_line_length`` bytes or
more have a null payload. What can't be decompressed gives no more lines; a plain file named like a tar archive none.
"""

from __future__ import annotations

import bz2
import gzip
import re
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_LINE_BYTES = 65536
#: First bytes of each format; fixed values.
MAGIC = {"zip": b"PK", "gzip": b"\x1f\x8b", "bzip2": b"BZh"}
TAR_NAMES = r"\.(tar|tgz|tbz2?|tar\.(gz|bz2|xz|zst))$"
SPLIT, BLOCK = 128 << 20, 4 << 20
#: What a file costs besides its bytes, for small ones to share a partition.
OPENING = 1 << 20
PIECES = "file string, entry string, format string, begin long, end long, arrival_ms long"
LINES = "source string, file string, entry string, line long, arrival_ms long, payload string"


@dataclass(frozen=True)
class Piece:
    """Bytes ``begin`` to ``end`` of a plain file, or all of a compressed file or of an archive's entry."""

    file: str
    entry: str
    format: str
    begin: int
    end: int
    arrival_ms: int


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, inner = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3', 'abfss': 'abfs'}.get(scheme, scheme)}://{host}/")
    return system, f"{base.rstrip('/')}/{inner}" if base.strip("/") else (f"/{inner}" if scheme == "hdfs" else f"{host}/{inner}")


def opened(path: str) -> pa.NativeFile:
    system, inner = store(path)
    return system.open_input_file(inner)


def pieces_of(path: str, size: int, arrival_ms: int, split: int = SPLIT) -> list[Piece]:
    """The pieces of one file."""
    with opened(path) as file:
        head = file.read(3)
        kind = next((k for k, magic in MAGIC.items() if head.startswith(magic)), "plain")
        if kind == "zip":
            try:
                with zipfile.ZipFile(file) as archive:
                    kept = [i for i in archive.infolist() if not i.is_dir() and not i.filename.rpartition("/")[2].startswith(".")]
            except (zipfile.BadZipFile, pa.ArrowInvalid):  # too short for a directory, or none
                return []
            return [Piece(path, i.filename, kind, 0, i.file_size, arrival_ms) for i in kept]
    if kind != "plain":
        return [Piece(path, "", kind, 0, size, arrival_ms)]
    if re.search(TAR_NAMES, path.lower()):
        return []
    return [Piece(path, "", kind, at, min(at + split, size), arrival_ms) for at in range(0, size, split)]


def blocks(piece: Piece) -> Iterator[bytes]:
    """The bytes of a piece, decompressed; of a range of a plain file those from the byte before it on."""
    with opened(piece.file) as file:
        if piece.format == "plain":
            file.seek(max(0, piece.begin - 1))
            while block := file.read(BLOCK):
                yield block
            return
        try:
            if piece.format == "zip":
                with zipfile.ZipFile(file) as archive, archive.open(piece.entry) as stream:
                    while block := stream.read1(BLOCK):
                        yield block
            else:
                with (gzip.GzipFile(fileobj=file) if piece.format == "gzip" else bz2.BZ2File(file)) as stream:
                    while block := stream.read1(BLOCK):
                        yield block
        except (OSError, EOFError, zlib.error, zipfile.BadZipFile, NotImplementedError, RuntimeError):
            return


def framed(piece: Piece, limit: int = MAX_LINE_BYTES) -> Iterator[tuple[np.ndarray, list[bytes | None]]]:
    """Places and bytes of the lines that begin in a piece, a block's at a time; None for a line of ``limit`` bytes or more.

    A line without its end yet is held up to ``limit`` bytes; of more only the length is kept.
    """
    ranged = piece.format == "plain"
    at = max(0, piece.begin - 1) if ranged else 0
    held, held_at, lost = b"", at, False  # the line that isn't ended: its bytes unless there are too many, and its place
    skipping = ranged and piece.begin > 0  # the line that the byte before the range belongs to begins before it

    for block in blocks(piece):
        ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10)
        if not len(ends):
            lost = lost or len(held) + len(block) >= limit
            held = b"" if lost else held + block
            at += len(block)
            if ranged and held_at >= piece.end:
                return
            continue
        last = int(ends[-1])
        lines: list[bytes | None] = block[:last].split(b"\n")
        places = np.concatenate([[held_at], at + ends[:-1] + 1])
        lines[0] = None if lost else held + lines[0]
        lines = [None if x is None or len(x) >= limit else x for x in lines]
        if skipping:
            places, lines, skipping = places[1:], lines[1:], False
        if ranged and len(places) and places[-1] >= piece.end:
            lines = lines[: int(np.searchsorted(places, piece.end))]
            yield places[: len(lines)], lines
            return
        yield places, lines
        held, held_at = block[last + 1 :], at + last + 1
        lost = len(held) >= limit
        at += len(block)
        if ranged and held_at >= piece.end:
            return
    if (held or lost) and not skipping and not (ranged and held_at >= piece.end):
        yield np.array([held_at]), [None if lost else held]


def stem(path: str) -> str:
    """A file's name without its last extension."""
    name = path.rpartition("/")[2]
    return re.fullmatch(r"([^/]+?)(?:\.[^./]*)?", name)[1] if name else ""


def line_batches(piece: Piece, limit: int = MAX_LINE_BYTES) -> Iterator[pa.RecordBatch]:
    for places, lines in framed(piece, limit):
        payload = pa.array([None if x is None else x.rstrip(b"\r").decode("utf-8", "replace") for x in lines], pa.string())
        same = lambda value, kind, n=len(lines): pa.repeat(pa.scalar(value, kind), n)
        yield pa.RecordBatch.from_arrays(
            [same(stem(piece.file), pa.string()), same(piece.file, pa.string()), same(piece.entry, pa.string()), pa.array(places, pa.int64()), same(piece.arrival_ms, pa.int64()), payload],
            names=["source", "file", "entry", "line", "arrival_ms", "payload"],
        )


def pieces(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """The pieces of a table of files (path, size, mtime_ms); each task opens its files' heads and archive directories."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with ThreadPoolExecutor(16) as pool:
                found = [p for some in pool.map(lambda row: pieces_of(row["path"], row["size"], row["mtime_ms"], split), batch.to_pylist()) for p in some]
            yield pa.RecordBatch.from_pylist([vars(p) for p in found], schema=pa.schema([("file", pa.string()), ("entry", pa.string()), ("format", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("arrival_ms", pa.int64())]))

    return files.select("path", "size", "mtime_ms").mapInArrow(cut, PIECES)


def read_pieces(cut: DataFrame, limit: int = MAX_LINE_BYTES) -> DataFrame:
    """The lines of a table of pieces."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from line_batches(Piece(**row), limit)

    return cut.select("file", "entry", "format", "begin", "end", "arrival_ms").mapInArrow(read, LINES)


def dealt(cut: DataFrame, partitions: int) -> DataFrame:
    """Pieces spread over tasks whatever file they are of."""
    return cut.repartition(max(1, partitions), F.xxhash64("file", "entry", "begin"))


class Bundle(InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(None)
        self.pieces = pieces


def bundled(found: list[Piece], split: int) -> list[Bundle]:
    """Pieces in a row share a partition until it holds ``split`` bytes."""
    out, size = [], 0
    for piece in found:
        own = piece.end - piece.begin + OPENING
        if not out or size + own > split:
            out.append([])
            size = 0
        out[-1].append(piece)
        size += own
    return [Bundle(some) for some in out]


class LineReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.limit = int(options.get("maxlinelength", MAX_LINE_BYTES))

    def partitions(self) -> list[Bundle]:
        system, inner = store(self.path)
        told = system.get_file_info(inner)
        found = [told] if told.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
        prefix = self.path[: len(self.path) - len(inner)] if self.path.endswith(inner) else ""
        kept = [f for f in found if f.is_file and not any(part.startswith((".", "_")) for part in f.path[len(inner) :].split("/"))]
        with ThreadPoolExecutor(16) as pool:
            cut = pool.map(lambda f: pieces_of(prefix + f.path, f.size, f.mtime_ns // 1_000_000, self.split), sorted(kept, key=lambda f: f.path))
            return bundled([p for some in cut for p in some], self.split)

    def read(self, partition: Bundle) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces:
            yield from line_batches(piece, self.limit)


class LineFiles(DataSource):
    """``seamark_lines``: options path, split (bytes a partition) and maxLineLength."""

    @classmethod
    def name(cls) -> str:
        return "seamark_lines"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> LineReader:
        return LineReader(self.options)
