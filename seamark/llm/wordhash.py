"""Vectorised word hashing for Arrow batches of texts.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``. The words of a whole batch are hashed
at once with a polynomial over the batch's bytes, so no Python object is made per word.
Words are compared by these 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[str, np.ndarray] = {}


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which gives back what Arrow's pool keeps after each batch: workers outlive their tasks, and would hold the most that any of these took."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    return lambda batches: run(tidied(batches))


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for many spans of a byte array."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a batch: byte spans and hashes, and for document i the range first[i]:first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    doc_starts: np.ndarray


def chunks(texts: list, limit: int = 1 << 18, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters and up to ``most`` texts in each, one text at least; few enough that their hashes stay in a core's cache."""
    begin = size = 0
    for i, text in enumerate(texts):
        length = len(text or "")
        if i > begin and (size + length > limit or i - begin == most):
            yield begin, i
            begin, size = i, 0
        size += length + 1
    if begin < len(texts):
        yield begin, len(texts)


def words(texts: list, lower: bool = False) -> Words:
    parts = [(t or "").encode() for t in texts]
    buffer = b"\n".join(parts) + b"\n"
    if lower:
        buffer = buffer.lower()  # of bytes: A-Z only
    data = np.frombuffer(buffer, np.uint8)
    doc_starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=doc_starts[1:])
    solid = ~SPACE[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(before & ~solid)
    return Words(data, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, doc_starts), doc_starts)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total = mix(total * np.uint64(0x9FB21C651E98DF25) + hashes[j : j + n])
    return total


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingles; of fewer words the whole sequence as one; of none nothing."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(windows(hashes, min(k, len(hashes))))
