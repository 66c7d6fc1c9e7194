"""Near-duplicate documents by an LSH forest over MinHash signatures.

Each document's distinct word shingles give a signature of 64 minima. Documents with equal sets form
a class. Sixteen trees order the class representatives by different parts of the signature;
``neighbours`` finds those with the longest common prefixes, deeper where a region is crowded.
Candidates whose sketches agree too little to be similar are dropped, the rest confirmed on the full
sets, and links joined into components. Then all rows of a crowded region that are in different
components are compared exactly, so that any two similar documents with a common prefix are joined.

Null texts and texts without words have empty sets and link with nothing, as do rows with a null
doc_id. Rows with equal doc_ids are one document. Repeated rows are returned each. Empty input gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.components import components
from seamark.llm.neighbours import candidate_pairs, confirm, estimate_filter, joined, prefixes
from seamark.llm.storage import materialize
from seamark.llm.wordhash import chunks, mix, released, shingle_set, words

HASHES, TREES = 64, 16
DEPTHS = (4, 6, 9, 13)
#: 4.5 standard deviations of the estimate under 0.8.
LEAST_ESTIMATE = 0.575
_rng = np.random.default_rng(20)
ODD = _rng.integers(1, 1 << 32, HASHES, np.uint32) | np.uint32(1)
FLIP = _rng.integers(0, 1 << 32, HASHES, np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash over a set that isn't empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 4096):
        values = (low[at : at + 4096, None] ^ FLIP) * ODD
        values ^= values >> np.uint32(15)
        best = np.minimum(best, (values * np.uint32(0x2C1B3C6D)).min(axis=0))
    return best


def document_sets(texts: list, shingle: int) -> Iterator[np.ndarray]:
    for low, high in chunks(texts):
        found = words(texts[low:high], lower=True)
        for a, b in zip(found.first[:-1], found.first[1:], strict=True):
            yield shingle_set(found.hashes[a:b], shingle)


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, signs, bits = [], [], [], [], []
            for found in document_sets(batch.column("text").to_pylist(), shingle):
                sign = signature(found) if len(found) else np.zeros(HASHES, np.uint32)
                sizes.append(len(found))
                mixed = mix(found)
                one.append(int(mixed.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(np.bitwise_xor.reduce(mixed * np.uint64(0x9FB21C651E98DF25)).view(np.int64)) if len(found) else 0)
                signs.append(sign.view(np.int32))
                bits.append((sign >> np.uint32(7)).astype(np.uint8).tobytes())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(signs) + 1) * HASHES, pa.int32()), pa.array(np.concatenate(signs) if signs else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists, pa.array(bits, pa.binary())], names=["doc_id", "n_shingles", "set1", "set2", "signature", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), "doc_id long, n_shingles long, set1 long, set2 long, signature array<int>, bits binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    rows = materialize(sketch(docs, shingle), "sketches")
    linkable = rows.where("doc_id is not null and n_shingles > 0")
    classes = materialize(linkable.groupBy("set1", "set2").agg(F.min("doc_id").alias("id")), "classes")
    leads = linkable.join(classes, ["set1", "set2"]).where("doc_id = id").dropDuplicates(["id", "set1", "set2"])
    leads = materialize(leads.select("id", F.col("n_shingles").alias("size"), "signature", "bits"), "leads")

    pairs, crowded = candidate_pairs(leads, lambda some: prefixes(some, TREES, HASHES // TREES, DEPTHS), percent)
    likely = materialize(estimate_filter(pairs, leads, LEAST_ESTIMATE), "likely")

    # the texts of documents that met another, once for all comparisons
    met = likely.select(F.col("a").alias("id")).union(likely.select("b")).union(crowded.select("id")).distinct()
    named = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    met_texts = materialize(named.join(materialize(met, "met-documents"), "id"), "met-texts")

    def fetch(wanted: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [s.tobytes() for s in document_sets(batch.column("text").to_pylist(), shingle)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("blocks"), pa.array(sets, pa.binary())], names=["id", "blocks", "data"])

        return met_texts.join(wanted, "id").select("id", "blocks", "text").mapInArrow(released(run), "id long, blocks array<long>, data binary")

    to_sets = lambda sets: [np.frombuffer(d, np.uint64) for d in sets]
    links = materialize(confirm(likely, fetch, to_sets, percent), "links")
    found = joined(components(links), crowded, fetch, to_sets, percent)
    named = materialize(classes.join(found, classes.id == found.node, "left").select("set1", "set2", F.coalesce("component", "id").alias("component_id")), "named")
    told = linkable.select("doc_id", "n_shingles", "set1", "set2").join(named, ["set1", "set2"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return told.union(alone)
