"""Language identification by nearest centroids of TF-IDF character n-grams.

A text's letters (lowered; anything else counts as a gap) give 1- to 3-grams, hashed into a fixed
number of features and weighed by log(1 + count) and inverse document frequency. Each language has
several centroids, found by spherical k-means on a bounded sample of labelled rows: up to
``per_language`` rows of each label, drawn by a hash of id, text and row, so that rows that repeat an id don't come together.
All labels are learned; more than ``max_languages`` of them are an error. A text gets the language of the centroid with the largest cosine. Texts further from it
than nearly all rows that the centroid was made of are marked as rejected.

Null texts and texts without a letter are ``und`` with score 0, as is everything where no labelled
row exists. Ties go to the language that sorts first. Repeated rows are predicted each. Only the
text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.wordhash import chunks

FEATURES = 4096
#: Texts counted at once: a row of counts takes 32 KB.
TEXTS = 500
_tables: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _tables:
        _tables["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _tables["letters"]


def gram_counts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts (texts x FEATURES), and whether each text has a letter."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[points]
    points = np.where(known, points, 0).astype(np.uint64)
    docs = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    total = np.zeros(len(texts) * FEATURES, np.int64)
    code = np.zeros(len(points), np.uint64)
    some = np.zeros(len(points), bool)
    for order in range(3):
        n = len(points) - order
        if n <= 0:
            break
        code = (code[:n] + np.uint64(order + 1)) * np.uint64(0x9E3779B97F4A7C15) + points[order:] * np.uint64(0xC2B2AE3D27D4EB4F)
        some = some[:n] | known[order:]
        good = some if not order else some & (docs[:n] == docs[order:])
        slot = ((code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(52)).astype(np.int64)
        total += np.bincount((docs[:n] * FEATURES + slot)[good], minlength=len(total))
    has = np.bincount(docs[known], minlength=len(texts)) > 0
    return total.reshape(len(texts), FEATURES), has


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # cosine under which each centroid rejects

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, and the cosine."""
        cosines = unit(np.log1p(counts).astype(np.float32) * self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        return best, cosines[np.arange(len(best)), best]


def cluster(rows: np.ndarray, k: int, steps: int = 15) -> np.ndarray:
    """Spherical k-means; the first centre is the mean's nearest row, each next one the row furthest from all before."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centres = rows[chosen]
    for _ in range(steps):
        own = (rows @ centres.T).argmax(axis=1)
        centres = unit(np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def fit(labelled: DataFrame, per_language: int = 400, max_languages: int = 2000, centroids: int = 4) -> Model | None:
    """Learns from rows (doc_id, text, lang) with a language; None if there are none."""
    counts = labelled.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return None
    # half as many again as are wanted, and of these the first; so a task ranks a bounded number of rows of a label
    rates = F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], min(1.0, 1.5 * per_language / row["count"]))])
    row = F.xxhash64("doc_id", "text", F.monotonically_increasing_id(), F.lit(7))
    place = F.pmod(row, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.select("lang", "text", row.alias("row"), place.alias("place")).where(F.col("place") < rates[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "row"))
    drawn = drawn.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in chunks(texts, most=TEXTS):
                grams, has = gram_counts(texts[low:high])
                rows = [np.stack([at := np.flatnonzero(g), np.minimum(g[at], 65535)]).astype("<u2").tobytes() if h else None for g, h in zip(grams, has, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(low, high - low), pa.array(rows, pa.binary())], names=["lang", "grams"])

    sample = drawn.mapInArrow(count, "lang string, grams binary")
    rows = sorted((r["lang"], bytes(r["grams"])) for r in sample.where("grams is not null").collect())  # per_language rows for each language at most
    if not rows:
        return None
    found_in = sum(np.bincount(np.frombuffer(g, "<u2").reshape(2, -1)[0], minlength=FEATURES) for _, g in rows)
    idf = (np.log((1 + len(rows)) / (1 + found_in)) + 1).astype(np.float32)
    names, centres, least = [], [], []
    for lang in sorted({x for x, _ in rows}):
        some = [np.frombuffer(g, "<u2").reshape(2, -1) for x, g in rows if x == lang]
        counted = np.zeros((len(some), FEATURES), np.float32)
        for row, (at, number) in zip(counted, some, strict=True):
            row[at] = number
        own = unit(np.log1p(counted) * idf)
        found = cluster(own, centroids)
        cosines = own @ found.T
        near = cosines.argmax(axis=1)
        for j, centre in enumerate(found):
            names.append(lang)
            centres.append(centre)
            least.append(0.8 * float(np.quantile(cosines[near == j, j], 0.01)) if (near == j).any() else 0.0)
    return Model(names, np.stack(centres).astype(np.float32), idf, np.array(least))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, lang_pred, score and rejected."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in chunks(texts, most=TEXTS):
                grams, has = gram_counts(texts[low:high])
                if model:
                    best, cosines = model.predict(grams)
                    names = [model.languages[b] if h else "und" for b, h in zip(best, has, strict=True)]
                    scores = np.where(has, np.clip(cosines.astype(float), 0, 1), 0.0)
                    rejected = ~has | (cosines < model.least[best])
                else:
                    names, scores, rejected = ["und"] * len(has), np.zeros(len(has)), np.ones(len(has), bool)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")
