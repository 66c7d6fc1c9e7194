"""Quality rules: per-document measures, and lines that too many documents of a host share.

A line is normalised (trimmed, A-Z lowered, runs of white space as one space, digits as 0) and
hashed. For each host (``source``) the distinct documents that hold a line are counted; documents
with identical texts are one document, so copies alone don't make boilerplate. A line is boilerplate
where more than ``max(min_docs, max_share * documents of the host)`` documents of the host hold it.
A document is depleted, and rejected, where fewer than ``min_words`` words, or less than
``min_left_percent`` % of its words, are left outside such lines. ``quality`` gives the verdicts,
``cleaned`` the texts of kept documents without the boilerplate lines.

Null texts have no words and fail. A null source is a host of its own. Repeated rows are judged
each on their own. Empty input gives no rows. Other columns are ignored, and ``cleaned`` returns them
as they came, but for text and n_chars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.storage import free_name, materialize, small
from seamark.llm.wordhash import SPACE, Words, chunks, mix, released, span_hashes, windows, words

#: Measures, and the hash and number of words of each distinct line.
MEASURE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_hash long, line_hashes array<long>, line_words array<int>"
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
FOLD[ord("0") : ord("9") + 1] = ord("0")


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over bounds[i]:bounds[i + 1]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(found: Words, span: int = 3) -> np.ndarray:
    """Per document the words that lie in windows found twice or more in it."""
    n = len(found.hashes)
    covered = np.zeros(n + 1, np.int64)
    docs = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    keys = windows(found.hashes, span)
    if len(keys):
        inside = docs[: len(keys)] == docs[span - 1 :]
        at = np.flatnonzero(inside)
        keys = mix(keys[at] ^ mix(docs[at].astype(np.uint64)))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + span, -1)
    return sums(np.cumsum(covered)[:n] > 0, found.first)


def line_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines of a batch whose texts end in a newline each."""
    ends = np.flatnonzero(data == 10)
    return np.concatenate([[0], ends[:-1] + 1]), ends


def normal_lines(found: Words) -> tuple[np.ndarray, ...]:
    """Of each line of a batch: its byte span, number of words and hash as normalised; and the first line of each document."""
    data = found.data
    starts, ends = line_bounds(data)
    line_words = np.searchsorted(found.starts, ends) - np.searchsorted(found.starts, starts)
    # of the normalised line: the sequence of its folded words
    folded = span_hashes(FOLD[data], found.starts, found.ends) if len(found.starts) else found.hashes
    spread = folded * (np.arange(len(folded), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    # position-weighted sums, with the position counted from the line's first word
    total = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
    plain = np.concatenate([[np.uint64(0)], np.cumsum(folded, dtype=np.uint64)])
    low, high = np.searchsorted(found.starts, starts), np.searchsorted(found.starts, ends)
    shift = low.astype(np.uint64) * np.uint64(2)
    normal = mix((total[high] - total[low]) - shift * (plain[high] - plain[low]) + line_words.astype(np.uint64))
    return starts, ends, line_words, normal, np.searchsorted(starts, found.doc_starts)


def measure_batch(texts: list) -> list[np.ndarray | list]:
    found = words(texts)
    data = found.data
    solid = ~SPACE[data]
    word_chars = sums(solid & ((data & 0xC0) != 0x80), found.doc_starts)
    symbols = sums(SYMBOL[data], found.doc_starts)
    starts, ends, line_words, normal, lines_first = normal_lines(found)
    exact = span_hashes(data, starts, ends)
    text_hash = span_hashes(data, found.doc_starts[:-1], found.doc_starts[1:] - 1)
    dups, hashes, counts = [], [], []
    for a, b in zip(lines_first[:-1], lines_first[1:], strict=True):
        some = line_words[a:b] > 0
        dups.append(int(some.sum()) - len(np.unique(exact[a:b][some])))
        kinds, where = np.unique(normal[a:b][some], return_inverse=True)
        hashes.append(kinds.view(np.int64))
        counts.append(np.bincount(where, line_words[a:b][some], len(kinds)).astype(np.int32))
    return [np.diff(found.first), word_chars, symbols, np.array(dups, np.int64), repeated_words(found), text_hash.view(np.int64), hashes, counts]


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` and the measures of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in chunks(texts):
                *numbers, hashes, counts = measure_batch(texts[low:high])
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (hashes, counts)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(low, high - low) for c in carry), *(pa.array(n.astype(np.int64)) for n in numbers), *lists], names=names)

    names = [*carry, *(x.split()[0] for x in MEASURE_SCHEMA.split(", "))]
    kinds = dict(docs.dtypes)
    return docs.select(*carry, "text").mapInArrow(released(run), ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), MEASURE_SCHEMA]))


def judged(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, min_docs: int = 4, max_share: float = 0.05, min_left_percent: int = 50, row: str | None = None) -> DataFrame:
    """The columns of ``quality``, and removed, the hashes of the row's boilerplate lines (null if there are none)."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    base = docs.select(number.alias("row_id"), F.col("doc_id"), F.coalesce(F.col("source"), F.lit("\0")).alias("host"), "text")
    rows = materialize(measure(base, ["row_id", "doc_id", "host"]), "measures")
    # distinct texts, so that a copied document counts once
    texts = rows.groupBy("host", "text_hash").agg(F.min("row_id").alias("row_id"))
    limits = texts.groupBy("host").agg(F.greatest(F.lit(float(min_docs)), F.count("*") * F.lit(max_share)).alias("most"))
    once = rows.select("row_id", "host", "line_hashes").join(texts.select("row_id"), "row_id", "left_semi")
    counted = once.select("host", F.explode("line_hashes").alias("line")).groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > min_docs)
    pairs = F.explode(F.arrays_zip("line_hashes", "line_words")).alias("of")
    lines = rows.select("row_id", "host", pairs).select("row_id", "host", F.col("of.line_hashes").alias("line"), F.col("of.line_words").alias("words"))
    frequent = counted.join(limits, "host").where(F.col("docs") > F.col("most")).select("host", "line")
    removed = lines.join(frequent, ["host", "line"], "left_semi").groupBy("row_id").agg(F.sum("words").alias("boilerplate_words"), F.collect_list("line").alias("removed"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    lost = F.coalesce(F.col("boilerplate_words"), F.lit(0))
    left = F.col("n_words") - lost
    depleted = (left < min_words) | (100 * left < min_left_percent * F.col("n_words"))
    return rows.join(removed, "row_id", "left").select(
        "row_id", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), lost.cast("long").alias("boilerplate_words"), (~failed & ~depleted).alias("kept"), "removed",
    )


def quality(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, min_docs: int = 4, max_share: float = 0.05, min_left_percent: int = 50, row: str | None = None) -> DataFrame:
    """Per row: row_id (the column ``row``, if one is named), doc_id, the measures, base_failed, boilerplate_words and kept."""
    return judged(docs, min_words, max_repeat_percent, min_docs, max_share, min_left_percent, row).drop("removed")


def strip_lines(texts: list, removed: list[np.ndarray]) -> list[str]:
    """The texts without the lines whose hashes are in ``removed``."""
    left = []
    for low, high in chunks(texts):
        _, _, line_words, normal, first = normal_lines(words(texts[low:high]))
        for text, hashes, a, b in zip(texts[low:high], removed[low:high], first[:-1], first[1:], strict=True):
            gone = (line_words[a:b] > 0) & np.isin(normal[a:b].view(np.int64), hashes)
            left.append("\n".join(line for line, drop in zip(text.split("\n"), gone, strict=True) if not drop))
    return left


def cleaned(docs: DataFrame, verdicts: DataFrame, row: str) -> DataFrame:
    """Kept documents without their boilerplate lines, n_chars counted anew; ``verdicts`` are of ``judged`` with the same ``row``."""
    names, removed = docs.columns, free_name(docs, "__removed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = strip_lines(batch.column("text").to_pylist(), [np.array(x, np.int64) for x in batch.column(removed).to_pylist()])
            columns = [pa.array(left, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    told = materialize(verdicts.select(F.col("row_id").alias(row), "kept", F.col("removed").alias(removed)), "verdicts")
    has = free_name(docs, "__has")
    kept = docs.join(small(told.where("kept").select(row, F.col(removed).isNotNull().alias(has))), row)
    same = kept.where(~F.col(has))
    # only documents with boilerplate meet the lists of their lines
    cut = kept.where(F.col(has)).join(told.where("kept").select(row, removed), row).mapInArrow(released(run), docs.schema)
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.select(*names).union(cut)
