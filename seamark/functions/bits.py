"""Reading and writing AIS bit fields with built-in string functions.

A six-bit armored payload is base64 with another alphabet, so ``translate`` and ``unbase64`` unpack it
inside generated code. Bits are held as a string of hexadecimal digits; a field is a few digits, shifted
and masked. Where a message has many fields, its digits are first turned into numbers of 48 bits, and fields
are shifted and masked out of these. Digits past the end read as 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.settle import settled

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Armor characters 0 to w; those between W and ` stand for the values of Q to W, but for X, which stands for that of `.
ARMOR = "".join(map(chr, range(48, 120)))
ARMOR_VALUES = [c - 48 if c <= 88 else c - 56 for c in range(48, 120)]
#: Canonical armor of the values 0 to 63, and their characters in six-bit text.
CANONICAL = "".join(chr(v + 48 if v < 40 else v + 56) for v in range(64))
SIX_BIT_TEXT = "".join(chr(v + 64 if v < 32 else v) for v in range(64))


def armored_hex(armor: Column) -> Column:
    """Hexadecimal digits of an armored payload; null if a character is invalid."""
    coded = F.translate(armor, ARMOR, "".join(BASE64[v] for v in ARMOR_VALUES))
    padded = F.concat(coded, F.repeat(F.lit("A"), F.pmod(-F.length(armor), F.lit(4)).cast("int")))
    digits = F.substring(F.hex(F.unbase64(padded)), F.lit(1), F.ceil(F.length(armor) * 1.5).cast("int"))
    return F.when(F.rlike(armor, F.lit("^[0-w]+$")), digits)


def bit_length(armor: Column, fill: Column) -> Column:
    return F.greatest(6 * F.length(armor) - fill, F.lit(0))


WORD = 48


def with_words(df: DataFrame, length: int) -> DataFrame:
    """Adds word0, word1, ...: the first ``length`` bits of the column digits, WORD bits each."""
    return settled(df, **{f"word{k}": unsigned(F.col("digits"), k * WORD, WORD) for k in range(-(-length // WORD))})


def in_words(offset: int, width: int) -> Column:
    """Bits offset to offset + width of the columns of ``with_words``; width at most WORD."""
    k, end = offset // WORD, offset % WORD + width
    if end <= WORD:
        value = F.shiftright(f"word{k}", WORD - end)
    else:
        value = F.shiftleft(f"word{k}", end - WORD).bitwiseOR(F.shiftright(f"word{k + 1}", 2 * WORD - end))
    return value.bitwiseAND(F.lit((1 << width) - 1))


def unsigned(digits: Column | None, offset: int, width: int) -> Column:
    """Bits offset to offset + width as a bigint, width at most 48; here and below, digits are None where the row has words."""
    if digits is None:
        return in_words(offset, width)
    first, last = offset // 4, (offset + width - 1) // 4
    count = last - first + 1
    taken = F.rpad(F.substring(digits, first + 1, count), count, "0")
    value = F.conv(taken, 16, 10).cast("long")
    return F.shiftright(value, 4 * count - offset % 4 - width).bitwiseAND(F.lit((1 << width) - 1))


def signed(digits: Column | None, offset: int, width: int) -> Column:
    value = unsigned(digits, offset, width)
    return F.when(value >= 1 << (width - 1), value - (1 << width)).otherwise(value)


def flag(digits: Column | None, offset: int) -> Column:
    return unsigned(digits, offset, 1) == 1


def text(digits: Column | None, offset: int, characters: int) -> Column:
    """Six-bit text without the blanks and @ at its end; null if nothing is left."""
    return text_of([unsigned(digits, at, width) for at, width in text_places(offset, characters)], characters)


def text_places(offset: int, characters: int) -> list[tuple[int, int]]:
    """Offsets and widths of the numbers, of up to eight characters each, that hold a text."""
    return [(offset + 6 * at, 6 * min(8, characters - at)) for at in range(0, characters, 8)]


def text_of(numbers: list[Column], characters: int) -> Column:
    """The text of the numbers at ``text_places``. Their digits are joined first, so that each is written into the plan once."""
    parts = []
    for number, (_, width) in zip(numbers, text_places(0, characters), strict=True):
        filled = -(-width // 24) * 24
        parts.append(F.lpad(F.hex(F.shiftleft(number, filled - width)), filled // 4, "0"))
    letters = F.translate(F.base64(F.unhex(F.concat(*parts))), BASE64, SIX_BIT_TEXT)
    return trimmed(F.substring(letters, 1, characters))


def trimmed(value: Column) -> Column:
    return F.nullif(F.regexp_replace(value, "[ @]+$", ""), F.lit(""))


def hex_from(digits: Column, length: Column, offset: int) -> Column:
    """Upper-case digits of the bits from offset up to length; the last digit is filled with zeros. offset is a multiple of 4."""
    bits = F.greatest(length - offset, F.lit(0))
    return F.substring(digits, F.lit(offset // 4 + 1), F.ceil(bits / 4).cast("int"))


def null_if(value: Column, missing: int) -> Column:
    return F.nullif(value, F.lit(missing).cast("long"))


def bit_string(value: Column, width: int) -> Column:
    """A number, negative ones in two's complement, as 0 and 1."""
    return F.lpad(F.bin(F.when(value < 0, value + (1 << width)).otherwise(value).cast("long")), width, "0")


def text_bits(value: Column, characters: int) -> Column:
    """Upper-case text as six-bit characters, filled with @."""
    padded = F.rpad(F.substring(F.upper(value), 1, characters), -(-characters // 4) * 4, "@")
    coded = F.translate(padded, SIX_BIT_TEXT, BASE64)
    parts = [F.lpad(F.conv(F.hex(F.unbase64(F.substring(coded, at + 1, 4))), 16, 2), 24, "0") for at in range(0, characters, 4)]
    return F.substring(F.concat(*parts), 1, 6 * characters)


def armor_bits(bits: Column, width: int) -> Column:
    """Armor of a string of ``width`` bits, filled with zeros to whole characters."""
    characters = -(-width // 6)
    groups = -(-characters // 4)
    padded = F.rpad(bits, 24 * groups, "0")
    digits = F.concat(*[F.lpad(F.conv(F.substring(padded, 24 * g + 1, 24), 2, 16), 6, "0") for g in range(groups)])
    return F.substring(F.translate(F.base64(F.unhex(digits)), BASE64, CANONICAL), 1, characters)


def text_numbers(value: Column, characters: int) -> list[tuple[Column, int]]:
    """The bits of ``text_bits`` as numbers of up to four characters, with their widths."""
    found = []
    for at in range(0, characters, 4):
        n = min(4, characters - at)
        coded = F.translate(F.rpad(F.substring(F.upper(value), at + 1, n), 4, "@"), SIX_BIT_TEXT, BASE64)
        found.append((F.shiftright(F.conv(F.hex(F.unbase64(coded)), 16, 10).cast("long"), 6 * (4 - n)), 6 * n))
    return found


def armor_numbers(numbers: list[tuple[Column | int, int]]) -> Column:
    """Armor of (number, width) pairs, low bits of each, filled with zeros to whole characters.

    Numbers are shifted into words of WORD bits. Only one that crosses a word's end is written into the plan twice; a
    string of all bits would be, with all fields in it, for every four characters.
    """
    total = sum(width for _, width in numbers)
    fixed, parts, start = [0] * -(-total // WORD), [[] for _ in range(-(-total // WORD))], 0
    for number, width in numbers:
        end = start + width
        for k in range(start // WORD, -(-end // WORD)):
            first, last = max(start, k * WORD), min(end, (k + 1) * WORD)
            mask, left = (1 << (last - first)) - 1, (k + 1) * WORD - last
            if isinstance(number, int):
                fixed[k] |= (number >> (end - last) & mask) << left
            else:
                parts[k].append(F.shiftleft(F.shiftright(number.cast("long"), end - last).bitwiseAND(F.lit(mask).cast("long")), left))
        start = end
    words = [reduce(Column.bitwiseOR, some, F.lit(literal).cast("long")) for literal, some in zip(fixed, parts, strict=True)]
    digits = F.concat(*[F.lpad(F.hex(word), WORD // 4, "0") for word in words])
    return F.substring(F.translate(F.base64(F.unhex(digits)), BASE64, CANONICAL), 1, -(-total // 6))
