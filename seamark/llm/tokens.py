"""Token ids of Arrow batches of texts by public tokenizers, with a bounded table of known pieces.

Both vocabularies split every text at these seams, whatever stands around them: before a space that
follows a non-space; before ``.`` or ``,`` after a letter or number; before and after a newline between
non-spaces. So a text's ids are the joined ids of its pieces. Arrow cuts a chunk of texts, finds its
distinct pieces and takes their ids from the table; only pieces that a worker meets for the first time
reach the tokenizer. For a plain word, which its normalizers and splits leave as it is, that is its model;
other pieces are encoded many at once, with a special token between them. Texts with runs of white space are cut before spaces only, those with ``.`` or
``,`` elsewhere not before these, and texts that may hold a special token aren't cut at all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Known pieces at most, before the table is begun anew.
KNOWN_PIECES = 600_000
JOINED = 1000
#: White space of any kind, as a class of the expressions below.
SPACES = r"\s\v\x1c-\x1f\x{85}\p{Z}"
RUN = f"[{SPACES}]{{2}}|^[{SPACES}]|[{SPACES}]$"
ODD_MARK = r"(?:^|[^\p{L}\p{N}])[.,]"
#: Special tokens, the mark of cuts, and the letter that becomes two characters when lowered.
SPECIAL = r"<\||\x00|\x{130}"
ANY_ODD = f"{RUN}|{ODD_MARK}|{SPECIAL}"
CUT = "\0"
#: Letters that stay as they are when lowered or composed, and capitals where a vocabulary has them.
PLAIN_WORD, BARE_WORD = re.compile(" ?[A-Za-zà-öø-ÿ]+"), re.compile("[a-zà-öø-ÿ]+")
#: How byte-level vocabularies write bytes: printable ones as themselves, the others in order from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = dict(zip(sorted(set(range(256)) - set(PRINTABLE)), range(256, 512)))
#: Stands for the end of a text; no piece holds it.
END = "<|"

_encoders: dict[tuple[str, int], PieceEncoder] = {}


class PieceEncoder:
    """Encodes arrays of texts, each with the end id after it."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.mark_id, token = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark = token.content
        #: A vocabulary of words without spaces and capitals: pieces are lowered and lose the space before them.
        self.bare = self.plain(" A") == self.plain("a")
        self.plain_word = BARE_WORD if self.bare else PLAIN_WORD
        self.model = self.tokenizer.model
        self.forget()

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        self.place: dict[str, int] = {END: 0}
        self.ids, self.ends = np.array([self.end_id], np.int32), np.array([0, 1], np.int32)

    def learn(self, pieces: list[str]) -> None:
        """Adds pieces to the table."""
        plain, other = [], []
        for p in pieces:
            (plain if self.plain_word.fullmatch(p) else other).append(p)
        if plain:
            found = [[token.id for token in self.model.tokenize(p.encode().decode("latin-1").translate(BYTE_LETTERS))] for p in plain]
            self.add(plain, np.fromiter(chain.from_iterable(found), np.int32), np.cumsum([len(x) for x in found]))
        if other:
            joined = [self.mark.join([*other[at : at + JOINED], ""]) for at in range(0, len(other), JOINED)]
            ids = np.concatenate([np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
            self.add(other, ids[ids != self.mark_id], np.flatnonzero(ids == self.mark_id) - np.arange(len(other)))

    def add(self, pieces: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces)), strict=True))
        self.ends = np.concatenate([self.ends, (ends + len(self.ids)).astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        if len(self.ends) != len(self.place) + 1:
            raise ValueError("pieces and their ids don't match")

    def pieces(self, texts: pa.Array, runs: bool, marks: bool) -> pa.ListArray:
        """The pieces of texts that all have white space in runs (or at their ends), or none; and the same for odd marks."""
        if self.bare:
            texts = pc.ascii_lower(texts)
        space = CUT if self.bare else f"{CUT} "
        if runs:
            texts = pc.replace_substring_regex(texts, f"([^{SPACES}]) ", f"\\1{space}")
        else:
            texts = pc.replace_substring(pc.replace_substring(texts, " ", space), "\n", f"{CUT}\n{CUT}")
        for mark in "" if marks else ".,":
            texts = pc.replace_substring(texts, mark, CUT + mark)
        return pc.split_pattern(pc.binary_join_element_wise(texts, END, CUT), CUT)

    def whole(self, text: str) -> list[int]:
        return [*self.plain(text), self.end_id]

    def alike(self, texts: pa.Array, runs: bool, marks: bool) -> pa.ListArray:
        pieces = self.pieces(texts, runs, marks)
        coded = pieces.values.dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.place) + len(kinds) > KNOWN_PIECES:
            self.forget()
        if new := [p for p in kinds if p not in self.place]:
            self.learn(new)
        at = np.fromiter(map(self.place.__getitem__, kinds), np.int32, len(kinds))
        known = pa.ListArray.from_arrays(pa.array(self.ends), pa.array(self.ids))
        found = known.take(pa.array(at).take(coded.indices))
        return pa.ListArray.from_arrays(found.offsets.take(pieces.offsets), found.values)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Lists of 32-bit ids; a null is an empty text."""
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring_regex(texts, ANY_ODD)).as_py():
            return self.alike(texts, False, False)
        special, runs, marks = (pc.match_substring_regex(texts, x).to_numpy(zero_copy_only=False) for x in (SPECIAL, RUN, ODD_MARK))
        kind = np.where(special, 4, 2 * runs + marks)
        order, parts = np.argsort(kind, kind="stable"), []
        for k in np.unique(kind).tolist():
            some = texts.filter(pa.array(kind == k))
            parts.append(pa.array(map(self.whole, some.to_pylist()), pa.list_(pa.int32())) if k == 4 else self.alike(some, k > 1, k % 2 == 1))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return pa.concat_arrays(parts).take(pa.array(back))


def encoder(path: str, end_id: int) -> PieceEncoder:
    """The worker's encoder for a tokenizer file and an end id."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = PieceEncoder(path, end_id)
    return _encoders[path, end_id]


def text_chunks(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes in each, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        low = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, low + limit, "right")))
        yield begin, end
        begin = end


def crc32s(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of ids[bounds[i]:bounds[i + 1]] as little-endian unsigned 32-bit integers."""
    data = memoryview(ids.astype("<u4", copy=False)).cast("B")
    edges = (4 * bounds.astype(np.int64)).tolist()
    return np.array([zlib.crc32(data[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], np.int64)
