"""Parts of NMEA sentences and tag blocks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_block(line: Column) -> Column:
    """What stands between a leading pair of backslashes; empty if there is none, or no second one."""
    return F.regexp_extract(line, r"^\\([^\\]*)\\", 1)


def after_tag_block(line: Column) -> Column:
    return F.regexp_replace(line, r"^\\[^\\]*\\", "")


def prefix(line: Column) -> Column:
    """All before the first ! or $."""
    return F.regexp_extract(line, r"^([^!$]*)", 1)


def sentence(line: Column) -> Column:
    """All from the first ! or $ on."""
    return F.substr(line, F.length(prefix(line)) + 1)


def tag_field(tags: Column, key: str) -> Column:
    """A field of a tag block's body, up to its checksum; null if it is absent or empty."""
    body = F.regexp_extract(tags, r"^([^*]*)", 1)
    return F.nullif(F.trim(F.regexp_extract(body, rf"(?:^|,)\s*{key}:([^,]*)", 1)), F.lit(""))


def tag_seconds_ms(tags: Column) -> Column:
    """The c: field, in seconds, as milliseconds; null if it is 0, absent or too large."""
    digits = F.regexp_extract(tags, r"(?:^|[,\\])\s*c:(\d+)", 1)
    seconds = F.nullif(F.try_to_number(F.nullif(digits, F.lit("")), F.lit("9" * 15)).cast("long"), F.lit(0).cast("long"))
    return seconds * 1000


def field(text: Column, number: int) -> Column:
    """A comma-separated field (from 0) without its checksum and blanks; null past the end."""
    return F.trim(F.regexp_extract(F.get(F.split(text, ","), F.lit(number)), r"^([^*]*)", 1))


def whole(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(r"^\+?\d{1,9}$")), text).try_cast("int")


def checksum(body: Column) -> Column:
    """The exclusive or of a sentence's characters, as two hexadecimal digits."""
    folded = F.aggregate(F.split(body, ""), F.lit(0), lambda acc, c: acc.bitwiseXOR(F.ascii(c)))
    return F.lpad(F.hex(folded), 2, "0")


def closed(body: Column, start: str) -> Column:
    """A sentence with its checksum."""
    return F.concat(F.lit(start), body, F.lit("*"), checksum(body))


def is_ais(text: Column) -> Column:
    return F.coalesce(F.rlike(field(text, 0), F.lit("VD[MO]$")), F.lit(False))


def fragment_count(text: Column) -> Column:
    return F.when(is_ais(text), whole(field(text, 1)))


def fragment_number(text: Column) -> Column:
    return F.when(is_ais(text), whole(field(text, 2)))


def fragment_group(text: Column) -> Column:
    """Sentence type, count, sequence id and channel; null for whole messages and those without a sequence id."""
    some = (fragment_count(text) > 1) & (field(text, 3) != "")
    return F.when(some, F.concat_ws(":", field(text, 0), fragment_count(text).cast("string"), field(text, 3), F.coalesce(field(text, 4), F.lit(""))))


def capture_ms(text: Column) -> Column:
    """The time of a $PGHP line (type, year, month, day, hour, minute, second, milliseconds) in milliseconds, or null."""
    part = [whole(field(text, n)) for n in range(2, 9)]
    day = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", *part[:3]), F.lit("yyyy-MM-dd")).cast("date")
    clock = (part[3].between(0, 23)) & (part[4].between(0, 59)) & (part[5].between(0, 59)) & (part[6] < 1000)
    millis = F.unix_date(day).cast("long") * 86_400_000 + part[3] * 3_600_000 + part[4] * 60_000 + part[5] * 1000 + part[6]
    return F.when((field(text, 0) == "$PGHP") & clock, millis)


def armored(text: Column) -> Column:
    """The armored payload of an AIVDM or AIVDO sentence with all its fields; null if it is missing or empty."""
    good = F.rlike(text, F.lit(r"^\s*!AIVD[MO],\+?\d+,[^,]*,[^,]*,[^,]*,[^,]+,"))
    return F.when(good, F.get(F.split(text, ","), F.lit(5)))


def fill_bits(text: Column) -> Column:
    return F.coalesce(whole(field(text, 6)), F.lit(0))
