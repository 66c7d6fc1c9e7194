"""Writing AIS sentences from numbers; tests and queries decode what this wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seamark.functions import bits, sentences


def message(fields: Sequence[tuple[Column | int | str, int]]) -> tuple[Column, int]:
    """A bit string from (value, width) pairs, and its length; a pair (column, -n) is n characters of text."""
    parts, width = [], 0
    for value, size in fields:
        column = F.lit(value) if isinstance(value, (int, str)) else value
        parts.append(bits.text_bits(column, -size) if size < 0 else bits.bit_string(column, size))
        width += -6 * size if size < 0 else size
    return F.concat(*parts), width


def sentence(fields: Sequence[tuple[Column | int | str, int]], channel: str = "A") -> Column:
    return closed_once(unclosed(fields, channel))


def unclosed(fields: Sequence[tuple[Column | int | str, int]], channel: str = "A") -> Column:
    """The fields of ``message`` as a sentence's body. As a column of its own it is generated code; in a lambda function's argument it isn't."""
    numbers = []
    for value, size in fields:
        if size < 0:
            numbers += bits.text_numbers(F.lit(value) if isinstance(value, str) else value, -size)
        else:
            numbers.append((value, size))
    fill = -sum(width for _, width in numbers) % 6
    return F.concat(F.lit(f"AIVDM,1,1,,{channel},"), bits.armor_numbers(numbers), F.lit(f",{fill}"))


def armored_sentence(coded: Column, width: Column, longest: int, channel: str = "A") -> Column:
    """A sentence of ``width`` bits, of at most ``longest``."""
    armor = F.substring(bits.armor_bits(coded, longest), F.lit(1), F.ceil(width / 6).cast("int"))
    return closed_once(F.concat(F.lit(f"AIVDM,1,1,,{channel},"), armor, F.lit(","), F.pmod(-width, F.lit(6)).cast("string")))


def closed_once(body: Column) -> Column:
    """``sentences.closed``, with the body as the argument of a lambda function, so that it is written into the plan once."""
    return F.element_at(F.transform(F.array(body), lambda x: sentences.closed(x, "!")), 1)


def tagged(line: Column, station: Column | None = None, seconds: Column | None = None) -> Column:
    """The line with a tag block before it."""
    parts = ([F.concat(F.lit("s:"), station)] if station is not None else []) + ([F.concat(F.lit("c:"), seconds.cast("string"))] if seconds is not None else [])
    tags = F.concat_ws(",", *parts)
    block = F.element_at(F.transform(F.array(tags), lambda x: F.concat(x, F.lit("*"), sentences.checksum(x))), 1)
    return F.concat(F.lit("\\"), block, F.lit("\\"), line)
