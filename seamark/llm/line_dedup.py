"""Fuzzy line dedup: of similar lines across all documents, only the first stays.

Lines (split at newlines, trimmed and lowered for comparison) are named by a 64-bit hash, so equal lines
are one item from the start. An item's 8-character shingles give a one-permutation MinHash signature,
whose bands bring candidates together, all with all in a bucket of any size; exact Jaccard similarity
decides, and distributed star joins form components. Of each component the document with the smallest
doc_id keeps its first line; every other occurrence is removed. One pass over the texts writes what all
later steps read: of each document the hashes of its lines, and of each line that a task hasn't met its hash,
bands and text. Only the last step takes the texts again, and joins them to the numbers of removed lines.
In joins of texts or of all lines the other side has one small row a key; where its partitions are measured as small,
tasks hold theirs as a hash table, so that texts and lines are shuffled but not sorted, and elsewhere both sides are sorted.
Lines are equal where their 64-bit names are: among n different lines about n^2 / 2^65 pairs are taken as one, so less than one in
10^9 lines and some ten thousands in 10^12.

Blank lines are never removed. Null texts stay null. Documents keep their rows even where no line is
left (then the text is empty, or what blank lines leave). Rows with equal doc_ids count as one document,
so each of them keeps that document's lines; a row with a null doc_id is named by a hash of its text. Empty
input gives no rows. Columns other than doc_id and text are returned as they came, but n_chars is counted
anew, and n_lines and n_removed are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.components import components
from seamark.llm.neighbours import bucket_pairs, candidate_pairs, confirm, distinct_by_owner, joined
from seamark.llm.storage import bounded_batches, free_name, materialize, measured_hash_joins
from seamark.llm.wordhash import chunks, mix, powers, released, span_hashes

SHINGLE, BANDS, ROWS = 8, 12, 4
BINS = BANDS * ROWS
#: Of a line, by which pairs are ruled out; a power of two.
FLAGS = 2048
#: Of a bounded table that says which lines may have met another: words of 64 bits, one row each.
WORDS = 1 << 20
NONE = np.iinfo(np.uint32).max
#: Names of lines that a task has met, before it forgets them; a line that comes again in a task isn't written twice.
MET_LINES = 1 << 21


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each line's character shingles (a shorter line is one), and the line of each."""
    lengths = np.array([len(x) for x in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.cumsum(lengths) - lengths
    number = np.where(lengths > 0, np.maximum(lengths - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(lines)), number)
    starts = np.arange(len(owner)) + np.repeat(first - np.cumsum(number) + number, number)
    up, down = powers(len(points) + 1)
    total = np.zeros(len(points) + SHINGLE, np.uint64)  # the last sum is repeated, for shingles that would end after all lines
    np.cumsum((points + np.uint64(1)) * up[: len(points)], out=total[1 : len(points) + 1])
    total[len(points) + 1 :] = total[len(points)]
    value = ((total[SHINGLE:] - total[:-SHINGLE]) * down[: len(points)])[starts]
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    value[np.cumsum(number)[short] - 1] = (total[first[short] + lengths[short]] - total[first[short]]) * down[first[short]]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0x94D049BB133111EB)
    value ^= value >> np.uint64(32)
    return value, owner


def bands(lines: list[str]) -> np.ndarray:
    """Band keys (lines x BANDS) of one-permutation signatures; an empty bin borrows from the next full one."""
    hashes, owner = shingles(lines)
    place = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    sign = np.full(len(lines) * BINS, NONE, np.uint32)
    np.minimum.at(sign, owner * BINS + place, (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32))
    sign = sign.reshape(len(lines), BINS)
    around = np.where(np.concatenate([sign, sign], axis=1) != NONE, np.arange(2 * BINS), 4 * BINS)
    following = np.minimum.accumulate(around[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    lent = np.take_along_axis(sign, following % BINS, axis=1) + ((following - np.arange(BINS)) * 0x9E3779B1).astype(np.uint32)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(lines), 1))
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + lent[:, r::ROWS])
    return keys.view(np.int64)


def line_sets(data: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingles of each line."""
    return distinct_by_owner(*shingles([d.decode() for d in data]), len(data))


def possible_pairs(data: list[bytes], a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether lines a[i] and b[i] may be similar, by a bound on sets from flags of their shingles' hashes.

    Flags that only one of two lines has each stand for a shingle or more that the other lacks. A line has as many
    shingles as places of them at most, and the bound on the similarity doesn't fall with that number.
    """
    values, owner = shingles([d.decode() for d in data])
    flags = np.zeros((len(data), FLAGS), bool)
    flags[owner, (values & np.uint64(FLAGS - 1)).astype(np.int64)] = True
    flags = np.packbits(flags, axis=1)
    places, kept = np.bincount(owner, minlength=len(data)), np.zeros(len(a), bool)
    for low in range(0, len(a), 8192):
        x, y = a[low : low + 8192], b[low : low + 8192]
        ours, theirs = (np.bitwise_count(flags[u] & ~flags[v]).sum(axis=1, dtype=np.int64) for u, v in ((x, y), (y, x)))
        kept[low : low + 8192] = (100 * (places[x] - ours) >= percent * (places[x] + theirs)) & (100 * (places[y] - theirs) >= percent * (places[y] + ours))
    return kept


def known(names: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Whether each of some is in sorted names."""
    if not len(names):
        return np.zeros(len(some), bool)
    return names[np.minimum(np.searchsorted(names, some), len(names) - 1)] == some


def line_names(norms: list[str]) -> np.ndarray:
    """64-bit names of lines, 0 for blank ones; hashed in pieces that stay in a core's cache."""
    names = [np.empty(0, np.uint64)]
    for low, high in chunks(norms, 1 << 17):
        data = np.frombuffer("\n".join([*norms[low:high], ""]).encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.flatnonzero(data == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = span_hashes(data, starts, ends)
        hashes[hashes == 0] = 1
        hashes[starts == ends] = 0
        names.append(hashes)
    return np.concatenate(names)


def read_lines(docs: DataFrame) -> DataFrame:
    """A row for each document (id, version, hashes: of its lines, 0 for blank ones), and one for each line that a task meets first (hash, norm, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, fresh = np.empty(0, np.uint64), np.empty(0, np.uint64)  # sorted names, and those that aren't merged yet
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in chunks(texts, 2 << 20):
                parts = [t.split("\n") if t is not None else [] for t in texts[low:high]]
                norms = [line.strip().lower() for lines in parts for line in lines]
                hashes = line_names(norms)
                first = np.concatenate([[0], np.cumsum([len(lines) for lines in parts])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(first), pa.array(hashes.view(np.int64)))
                yield row_batch(id=batch.column("id").slice(low, high - low), version=batch.column("version").slice(low, high - low), hashes=lists)
                kinds, at = np.unique(hashes, return_index=True)
                new = (kinds != 0) & ~known(met, kinds) & ~known(fresh, kinds)
                kinds, at = kinds[new], at[new]
                fresh = np.sort(np.concatenate([fresh, kinds]))
                if len(fresh) > MET_LINES // 16:
                    met, fresh = np.sort(np.concatenate([met, fresh])) if len(met) < MET_LINES else fresh, fresh[:0]
                new = [norms[i] for i in at]
                for a, b in chunks(new, 1 << 16):
                    keys = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(bands(new[a:b]).ravel()))
                    yield row_batch(hash=pa.array(kinds[a:b].view(np.int64)), norm=pa.array(new[a:b], pa.string()), bands=keys)

    version = F.xxhash64("text")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), version).alias("id"), version.alias("version"), "text")
    return keyed.mapInArrow(released(run), "id long, version long, hashes array<long>, hash long, norm string, bands array<long>")


ROW_SCHEMA = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("hashes", pa.list_(pa.int64())), ("hash", pa.int64()), ("norm", pa.string()), ("bands", pa.list_(pa.int64()))])


def row_batch(**columns: pa.Array) -> pa.RecordBatch:
    """A batch with nulls in the columns that aren't given."""
    number = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(number, f.type)).cast(f.type) for f in ROW_SCHEMA], schema=ROW_SCHEMA)


def may_be_in(items: DataFrame, some: DataFrame) -> DataFrame:
    """The items whose id is in ``some``, and a few others: so that not all texts are shuffled to meet a few ids.

    Each id of ``some`` sets a bit of one of WORDS rows, which are broadcast; the more ids, the more others pass.
    """
    named = lambda table: table.withColumn("__word", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(WORDS)))
    bit = "shiftleft(1L, cast(pmod(xxhash64(id, 6), 64) as int))"
    words = materialize(named(some).groupBy("__word").agg(F.expr(f"bit_or({bit})").alias("__bits")), "words")
    return named(items).join(F.broadcast(words), "__word").where(f"__bits & {bit} != 0").select(*items.columns)


def similar_parts(items: DataFrame, percent: int) -> DataFrame:
    """Components (node, component) of similar items; items: id, norm, bands. An item may come several times."""

    pairs, crowded = bucket_pairs(items, lambda some: some.select(F.explode("bands").alias("k0"), "id"))
    # in crowded buckets lines meet those that share their next crowded bucket as well, before all that are left are compared
    following = F.lead("k0").over(Window.partitionBy("id").orderBy("k0"))
    deeper = materialize(crowded.select("k0", F.xxhash64("k0", following).alias("k1"), "id", F.lit(1).alias("size")), "deeper")
    more, _ = candidate_pairs(deeper, lambda some: some, percent, ("k0", "k1"))
    pairs = materialize(pairs.union(more).distinct(), "line-pairs")
    # the texts of lines that met another, once for all comparisons
    met = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(crowded.select("id")).distinct()
    met = materialize(met, "met-lines")
    texts = materialize(may_be_in(items.select("id", "norm"), met).join(met, "id"), "met-texts")

    def fetch(wanted: DataFrame) -> DataFrame:
        return texts.join(wanted, "id").select("id", "blocks", F.encode("norm", "utf-8").alias("data"))

    links = materialize(confirm(pairs, fetch, line_sets, percent, possible=possible_pairs), "line-links")
    return joined(components(links), crowded, fetch, line_sets, percent)


def removed_lines(told: DataFrame, parts: DataFrame) -> DataFrame:
    """Per document (id, version) the places of lines that go: all that belong to a group, but the first of each group in the document that keeps it."""
    at = told.where("hashes is not null").select("id", "version", F.posexplode("hashes").alias("at", "hash")).where("hash != 0")
    members = parts.select(F.col("node").alias("hash"), "component").union(parts.select("component", "component").distinct())
    counted = at.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    grouped = counted.join(members, "hash", "left").where("n > 1 or component is not null")
    grouped = materialize(grouped.select("hash", F.coalesce("component", "hash").alias("component"), "first"), "grouped")
    keepers = grouped.groupBy("component").agg(F.min("first").alias("keep"))
    affected = materialize(grouped.join(keepers, "component").select("hash", "component", "keep"), "affected")
    some = at.join(affected, "hash").select("id", "version", "at", F.when(F.col("id") == F.col("keep"), F.col("component")).alias("own"))
    # of rows that repeat, places come several times
    ours = some.where("own is not null").groupBy("id", "version", "own").agg(F.collect_set("at").alias("places"))
    others = some.where("own is null").groupBy("id", "version").agg(F.collect_set("at").alias("gone"))
    ours = ours.where("size(places) > 1").select("id", "version", F.expr("array_except(places, array(array_min(places)))").alias("gone"))
    found = others.union(ours).groupBy("id", "version").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    return materialize(found, "found")


#: The text without the lines whose places are in an array that isn't null; the outer transform names the lines, so that they are split once.
LEFT = """transform(array(split({text}, '\n', -1)), lines ->
    array_join(transform(array_except(sequence(0, size(lines) - 1), {gone}), at -> lines[at]), '\n'))[0]"""


def dedup_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without repeated lines, with n_lines and n_removed added."""
    measured_hash_joins(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    names = docs.columns
    key, version_key, gone = (free_name(docs, n) for n in ("__id", "__version", "__gone"))
    told = materialize(read_lines(docs), "lines")
    items = told.where("hash is not null").select(F.col("hash").alias("id"), "norm", "bands")
    found = removed_lines(told, similar_parts(items, percent))

    version = F.xxhash64("text")
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), version)).withColumn(version_key, version)
    # no broadcast: it would hold lists of places, of a table that grows with the documents
    marked = keyed.join(found.toDF(key, version_key, gone).hint("merge"), [key, version_key], "left")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.expr(LEFT.format(text="text", gone=f"`{gone}`")))
    counts = F.coalesce(newlines + 1, F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed")
    left = marked.select(*(text.alias(c) if c == "text" else c for c in names), *counts)
    if "n_chars" in names:
        counted = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", counted)
    return left
