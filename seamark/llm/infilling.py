"""Fill-in-the-middle: documents cut at two places and rewritten as prefix, suffix and middle, and back.

A text's places to cut are the byte offsets of its UTF-8 form at which a unit ends: 0, then one after each
code point, word or line. They are held as a compressed set of integers: offsets with the same high bits share a
container, which is an array of low bits, a bitmap or a list of runs, whichever is smallest, and the containers'
cardinalities are summed up. The k-th place is found in these sums and then in one container, and both cuts of all texts
of a batch are returned so. Text of one-byte letters is runs, mixed text bitmaps, and text of few units arrays.

Which places, and in what form, hashes of the row's id decide, so reruns agree. Spark's own functions put the
output together and restore texts from it. Null texts are empty, and empty texts plain. A null id counts as an empty one.
Texts that hold a marker are plain. Repeated rows are cut alike. Empty tables give no rows. Columns of the input stay;
those that have the name of a new one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1 << 16
#: An array may hold so many low halves before a bitmap is smaller.
ARRAY_MOST = BLOCK // 16
UNITS = ("characters", "words", "lines")


@dataclass(frozen=True)
class ArrayContainer:
    low: np.ndarray

    def select(self, k: int) -> int:
        return int(self.low[k])


@dataclass(frozen=True)
class BitmapContainer:
    words: np.ndarray

    def select(self, k: int) -> int:
        """The word that holds the k-th bit, by its words' summed counts, and the bit within it."""
        upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        word = int(np.searchsorted(upto, k, "right"))
        left = k - (int(upto[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[left])


@dataclass(frozen=True)
class RunContainer:
    starts: np.ndarray
    upto: np.ndarray

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, "right"))
        return int(self.starts[run]) + k - (int(self.upto[run - 1]) if run else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted distinct numbers under 65536."""
    begins = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(begins) < min(2 * len(low), BLOCK // 8):
        lengths = np.diff(begins, append=len(low))
        return RunContainer(low[begins], np.cumsum(lengths))
    if len(low) <= ARRAY_MOST:
        return ArrayContainer(low.astype(np.uint16))
    flags = np.zeros(BLOCK, bool)
    flags[low] = True
    return BitmapContainer(np.packbits(flags, bitorder="little").view(np.uint64))


class BoundarySet:
    """A sorted set of offsets."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        edges = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[edges]
        self.containers = [container(part & (BLOCK - 1)) for part in np.split(offsets, edges[1:])] if len(offsets) else []
        self.upto = np.append(edges[1:], len(offsets))

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        """The offset of which k are smaller."""
        at = int(np.searchsorted(self.upto, k, "right"))
        return (int(self.high[at]) << 16) + self.containers[at].select(k - (int(self.upto[at - 1]) if at else 0))


def boundaries(data: np.ndarray, unit: str = "characters") -> np.ndarray:
    """0 and the ends of all units of a UTF-8 text; white space belongs to the word before it, and a newline to its line."""
    if not len(data):
        return np.zeros(1, np.int64)
    if unit == "characters":
        ends = (data & 0xC0) != 0x80
        return np.append(np.flatnonzero(ends), len(data)) if ends[0] else np.concatenate([[0], np.flatnonzero(ends), [len(data)]])
    if unit == "words":
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        inner = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    else:
        inner = np.flatnonzero(data[:-1] == 10) + 1
    return np.concatenate([[0], inner, [len(data)]])


CUTS = "struct<units: bigint, first: bigint, second: bigint, first_byte: bigint, second_byte: bigint>"


def cuts_of(unit: str):
    @F.arrow_udf(CUTS)
    def cuts(texts: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        """The number of units of each text, and both cuts in units and in bytes, the smaller first."""
        data, ends = flat(texts)
        out = np.zeros((5, len(texts)), np.int64)
        for i, (a, b) in enumerate(zip(one.to_pylist(), other.to_pylist(), strict=True)):
            places = BoundarySet(boundaries(data[ends[i] : ends[i + 1]], unit))
            n = len(places) - 1
            low, high = sorted((a % (n + 1), b % (n + 1)))
            out[:, i] = n, low, high, places.select(low), places.select(high)
        return pa.StructArray.from_arrays([pa.array(x) for x in out], ["units", "first", "second", "first_byte", "second_byte"])

    return cuts


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts without nulls, and where each begins and the last ends."""
    texts = pc.cast(texts, pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "characters", plain_percent: int = 10, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """The documents with n (units), form (plain, psm or spm), output, and prefix_units and middle_units (null if plain)."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (draw[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    cut = docs.withColumns({"__cut": cuts_of(unit)(whole, draw[0], draw[1]), "form": form})
    data, low, high = whole.cast("binary"), F.col("__cut.first_byte").cast("int"), F.col("__cut.second_byte").cast("int")
    part = lambda begin, end: F.substring(data, begin + 1, end - begin).cast("string")
    prefix, middle, suffix = part(F.lit(0), low), part(low, high), part(high, F.octet_length(whole))
    spm = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    told = lambda units: F.when(F.col("form") != "plain", units)
    return cut.withColumns({
        "n": F.col("__cut.units"), "output": F.when(F.col("form") == "plain", whole).when(F.col("form") == "spm", spm).otherwise(psm),
        "prefix_units": told(F.col("__cut.first")), "middle_units": told(F.col("__cut.second") - F.col("__cut.first")),
    }).drop("__cut")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A marker that isn't the text's own stands once, so the parts can be told apart."""
    after = lambda mark: F.substring_index(output, mark, -1)
    inner = lambda opened, closed: F.substring_index(after(opened), closed, 1)
    psm = F.concat(inner(PREFIX, SUFFIX), after(MIDDLE), inner(SUFFIX, MIDDLE))
    spm = F.concat(inner(PREFIX, MIDDLE), after(MIDDLE), inner(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def infilling_sql() -> str:
    return """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), numbers AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST(CAST('0x' || substr(d, 1, 8) AS UBIGINT) AS BIGINT) AS h1, CAST(CAST('0x' || substr(d, 9, 8) AS UBIGINT) AS BIGINT) AS h2,
    CAST(CAST('0x' || substr(d, 17, 8) AS UBIGINT) AS BIGINT) AS h3, CAST(CAST('0x' || substr(d, 25, 8) AS UBIGINT) AS BIGINT) AS h4 FROM drawn
), cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""
