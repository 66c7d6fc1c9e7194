"""Packing documents into training sequences by non-negative least squares.

A document's ids are cut into full windows and one rest. Lengths are rounded up to a grid, and the
histogram over that grid (one number a class, so its size doesn't depend on the data) is all that
the driver sees. There, every combination of up to three classes that fills a window exactly is a
strategy; non-negative least squares finds how often to use each so that the histogram is used up;
counts are rounded down, and what is left over is packed greedily, largest class first. Pieces are
then numbered within their class, in salted buckets, and number k of a class takes the k-th slot
that the strategies offer it. Nothing but the histogram is gathered.

Null texts count as empty: their only id is the end id. Repeated rows are packed as often as they
come. Empty input gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.storage import materialize
from seamark.llm.tokens import crc32s, encoder, text_chunks
from seamark.llm.wordhash import released

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int, with_ids: bool) -> DataFrame:
    """One row per piece: full windows, and the rest of the document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, docs_of = batch.column("text"), batch.column("doc_id")
            for low, high in text_chunks(texts):
                coded = encoder(tokenizer, end_id).encode(texts.slice(low, high - low))
                first, ids = coded.offsets.to_numpy().astype(np.int64), coded.values.to_numpy()
                total = np.diff(first)
                number = -(-total // window)  # at least one: each document has its end id
                doc = np.repeat(np.arange(len(total)), number)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)) * window
                bounds = np.append(first[doc] + start, first[-1])
                arrays = [docs_of.slice(low, high - low).take(pa.array(doc)), pa.array(start), pa.array(np.diff(bounds)), pa.array(crc32s(ids, bounds)), pa.array(total[doc])]
                if with_ids:
                    arrays.append(pa.array([ids[x:y].astype("<u4").tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(arrays)])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(cut), PIECE_SCHEMA + ", ids binary" * with_ids)


def strategies(classes: int, depth: int) -> np.ndarray:
    """All multisets of up to ``depth`` classes that sum to ``classes``; unused places are 0."""
    found = []
    for some in combinations_with_replacement(range(1, classes + 1), depth - 1):
        last = classes - sum(some)
        if last >= some[-1]:
            found.append((*some, last))
    found += [(0,) * (depth - k) + s for k in range(1, depth) for s in (map(tuple, strategies(classes, k)) if k > 1 else [(classes,)])]
    return np.array(found, np.int64)


def solve_counts(choices: np.ndarray, histogram: np.ndarray, steps: int = 3000) -> np.ndarray:
    """min |A x - histogram| over x >= 0, where A counts classes in choices, by accelerated projected gradients."""
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(choices[:, j], x, size) for j in range(choices.shape[1])) * mask

    def slopes(r: np.ndarray) -> np.ndarray:
        return sum((r * mask)[choices[:, j]] for j in range(choices.shape[1]))

    mask = np.ones(size)
    mask[0] = 0
    v = np.ones(len(choices))
    for _ in range(30):
        v = slopes(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(choices))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * slopes(used(y) - histogram), 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        if (y - new) @ (new - x) > 0:
            t_new, y = 1.0, new
        else:
            y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of classes with their number of sequences; together they hold the histogram exactly. Entry 0 is unused."""
    classes = len(histogram) - 1
    choices = strategies(classes, depth)
    counts = np.floor(solve_counts(choices, histogram.astype(float)) + 1e-6).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    found = []
    for k in np.argsort(-counts, kind="stable"):
        pattern = tuple(int(c) for c in choices[k] if c)
        need = np.bincount(pattern, minlength=classes + 1)
        times = int(min(counts[k], (left[need > 0] // need[need > 0]).min())) if counts[k] else 0
        if times:
            left -= need * times
            found.append((pattern, times))
    while left.any():
        free, pattern, need = classes, [], np.zeros_like(left)
        while (fit := np.flatnonzero((left - need)[: free + 1] > 0)).size:
            c = int(fit[-1])
            pattern.append(c)
            need[c] += 1
            free -= c
        times = int((left[need > 0] // need[need > 0]).min())
        left -= need * times
        found.append((tuple(pattern), times))
    return found


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, grid: int = 8, depth: int = 3, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, and ids on request."""
    if window % grid:
        raise ValueError("the grid must divide the window")
    classes = window // grid
    pieces = materialize(cut_pieces(docs, tokenizer, end_id, window, with_ids), "pieces").withColumn("class", F.ceil(F.col("length") / grid).cast("int"))
    per_bucket = 50_000
    buckets = max(16, pieces.count() // per_bucket)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = pieces.groupBy("class", "bucket").agg(F.count("*").alias("n"))
    histogram = np.zeros(classes + 1, np.int64)
    for row in counts.groupBy("class").agg(F.sum("n").alias("n")).collect():  # one row per class
        histogram[row["class"]] = row["n"]

    lows: list[list[tuple[int, int, int]]] = [[] for _ in range(classes + 1)]
    at, base = [0] * (classes + 1), 0
    for pattern, times in plan(histogram, depth):
        for slot, c in enumerate(pattern):
            lows[c].append((at[c], base, slot))
            at[c] += times
        base += times
    flat = [(c * 2**40 + low, low, first, slot) for c, some in enumerate(lows) for low, first, slot in some]
    keys, low, first, slots = (np.array(x, np.int64) for x in zip(*flat, strict=True)) if flat else [np.zeros(1, np.int64)] * 4

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("class", "rank"))
            k = np.searchsorted(keys, c * 2**40 + rank, "right") - 1
            kept = [n for n in batch.schema.names if n not in ("class", "rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(first[k] + rank - low[k]), pa.array(slots[k])], names=[*kept, "sequence_id", "slot"])

    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("place", F.row_number().over(order) - 1).join(bases, ["class", "bucket"])
    columns = [f"{n} {t}" for n, t in pieces.dtypes if n not in ("class", "bucket")]
    ranked = ranked.select("class", (F.col("place") + F.col("base")).alias("rank"), *[c.split()[0] for c in columns])
    placed = ranked.mapInArrow(place, ", ".join([*columns, "sequence_id long", "slot long"]))
    within = Window.partitionBy("sequence_id")
    earlier = within.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *[c.split()[0] for c in columns],
        "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
        F.sum("length").over(within).alias("sequence_length"),
    )
