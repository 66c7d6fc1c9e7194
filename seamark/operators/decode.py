"""NMEA sentences to typed rows.

``parse`` unpacks every line once into columns (kind, msg_type, mmsi, digits, ...); each table is a filter
and a projection of them, so that Spark reads only the fields that a query uses. Nothing is a Python function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions import bits, labels, sentences, spatial, times
from seamark.functions.settle import settled
from seamark.operators import layouts

KINDS = {"positions": "position", "statics": "static", "meteo": "meteo", "binary": "binary", "atons": "aton", "other": "other"}
POSITION_TYPES, STATIC_TYPES = (1, 2, 3, 4, 9, 18, 19, 27), (5, 24)
UNDER_WAY = labels.NAV_STATUS[0]


def parse(lines: DataFrame) -> DataFrame:
    """Adds sentence, station, count, digits, bit_length, msg_type, mmsi, dac, fid and kind to rows with a payload."""
    line = F.trim("payload")
    split = settled(lines, sentence=sentences.after_tag_block(line), station=sentences.tag_field(sentences.tag_block(line), "s"))
    text, digits = F.col("sentence"), F.col("digits")
    found = settled(split, armor=sentences.armored(text), count=sentences.whole(sentences.field(text, 1)), fill=sentences.fill_bits(text))
    armored = F.col("armor").isNotNull()
    unpacked = settled(found, digits=bits.armored_hex(F.col("armor")), bit_length=bits.bit_length(F.col("armor"), F.col("fill")), count=F.when(armored, F.col("count")))
    whole = (F.col("count") == 1) & (F.col("bit_length") >= 6)
    typed = settled(unpacked, msg_type=F.when(whole, bits.unsigned(digits, 0, 6)).cast("int"), mmsi=bits.unsigned(digits, 8, 30))
    is_8 = F.col("msg_type") == 8
    named = settled(typed, dac=F.when(is_8, bits.unsigned(digits, 40, 10)).cast("int"), fid=F.when(is_8, bits.unsigned(digits, 50, 6)).cast("int"))
    return settled(named, kind=kind()).drop("fill")


def kind() -> Column:
    t = F.col("msg_type")
    meteo = (F.col("dac") == 1) & (((F.col("fid") == 31) & (F.col("bit_length") >= 360)) | ((F.col("fid") == 11) & (F.col("bit_length") >= 352)))
    return (
        F.when((F.col("sentence") == "") | F.col("digits").isNull(), "failed")
        .when(F.col("count") > 1, "incomplete")
        .when(t.isNull() | ~t.between(1, 27), "failed")
        .when(t == 8, F.when(meteo, "meteo").otherwise("binary"))
        .when(t.isin(*POSITION_TYPES), "position")
        .when(t.isin(*STATIC_TYPES), "static")
        .when(t == 21, "aton")
        .otherwise("other")
    )


def read(places: list, name: str) -> Column:
    """The field ``name`` at the place that the row's type has for it; null for other types. Rows are those of ``with_fields``."""
    if places[name][0][3] == "c":
        return bits.text_of(text_words(places, name), places[name][0][2])
    return by_type([(types, (bits.signed if how == "s" else bits.unsigned)(None, offset, width)) for types, offset, width, how in places[name]])


def text_words(places: list, name: str) -> list[Column]:
    """The numbers that hold a text field; a text is as long in all types that have it."""
    found = [[(types, bits.unsigned(None, at, width)) for at, width in bits.text_places(offset, characters)] for types, offset, characters, _ in places[name]]
    return [by_type(some) for some in zip(*found, strict=True)]


def by_type(values: list[tuple[tuple[int, ...], Column]]) -> Column:
    found = F.lit(None)
    for types, value in values:
        found = F.when(F.col("msg_type").isin(*types), value).otherwise(found)
    return found


def with_fields(rows: DataFrame, places: dict[str, list]) -> DataFrame:
    """Adds the words that hold all fields of ``places``."""
    return bits.with_words(rows, max(offset + width * (6 if how == "c" else 1) for some in places.values() for _, offset, width, how in some))


def degrees(raw: Column, limit: int, scale: float = 600000.0) -> Column:
    """Null for what isn't available, which is a degree over the limit, and for all else that lies beyond it."""
    return F.when(F.abs(raw) <= limit * scale, raw / scale)


def positions(parsed: DataFrame) -> DataFrame:
    place = layouts.by_type(layouts.POSITION)
    get = lambda name: F.col(f"raw_{name}")
    t = F.col("msg_type")
    scale = F.when(t == 27, 600.0).otherwise(600000.0)
    long_range = t == 27
    rows = with_fields(parsed.where("kind = 'position'"), place)
    rows = settled(rows, **{f"raw_{name}": read(place, name) for name in place})
    latitude, longitude = (F.when(F.abs(get(n)) <= limit * scale, get(n) / scale) for n, limit in (("lat", 90), ("lon", 180)))
    sog = F.when(long_range, bits.null_if(get("sog"), 63).cast("double")).when(t == 9, bits.null_if(get("sog"), 1023).cast("double")).otherwise(bits.null_if(get("sog"), 1023) / 10.0)
    cog = F.when(long_range, bits.null_if(get("cog"), 511).cast("double")).otherwise(F.when(get("cog") < 3600, get("cog") / 10.0))
    shown = F.when(t == 9, UNDER_WAY).when(t == 4, "").when(t.isin(18, 19), labels.NAV_STATUS[15]).otherwise(labels.nav_status(get("nav")))
    told = settled(rows, latitude=latitude, longitude=longitude).select(
        *key_columns(parsed),
        F.when(t == 4, "Base Station").when(t.isin(18, 19), "Class B").otherwise("Class A").alias("ais_class"),
        "latitude", "longitude", sog.alias("sog_knots"), cog.alias("cog"),
        bits.null_if(get("heading"), 511).cast("double").alias("heading_true"),
        bits.null_if(get("rot"), -128).cast("double").alias("rot"),
        bits.null_if(get("altitude"), 4095).cast("double").alias("altitude_m"),
        shown.alias("nav_status"), (get("accuracy") == 1).alias("high_accuracy"), (get("raim") == 1).alias("raim"),
        F.when(get("manoeuvre").isin(1, 2), get("manoeuvre") == 2).alias("special_manoeuvre"), "station", "payload",
    )
    return told.withColumn("hilbert", spatial.hilbert(F.col("latitude"), F.col("longitude")))


def key_columns(parsed: DataFrame) -> list[str]:
    return carried(parsed) + ["msg_type", "mmsi"]


def carried(parsed: DataFrame) -> list[str]:
    """Columns that tell where a row comes from, and its partition, if it has them."""
    return [c for c in ("ts_ms", "source", "file", "line", *times.GRAINS) if c in parsed.columns]


def eta_ms(month: Column, day: Column, hour: Column, minute: Column, year: Column) -> Column:
    """Milliseconds of an arrival time; a missing hour or minute is the last one; null without a valid day."""
    date = F.when((month > 0) & (day > 0), F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")), F.lit("yyyy-MM-dd"))).cast("date")
    minutes = F.least(F.coalesce(hour, F.lit(24)), F.lit(23)) * 60 + F.least(F.coalesce(minute, F.lit(60)), F.lit(59))
    return F.unix_date(date).cast("long") * 86_400_000 + minutes.cast("long") * 60_000


def statics(parsed: DataFrame, eta_year: int) -> DataFrame:
    """``eta_year`` is the year of arrival times, which messages don't carry."""
    place = layouts.by_type(layouts.STATIC)
    texts = {name: text_words(place, name) for name in place if place[name][0][3] == "c"}
    rows = with_fields(parsed.where("kind = 'static'"), place)
    # A step at a time: Java doesn't compile a method of over 8000 bytes, and one of all steps would have 29,785.
    numbers = {name: read(place, name) for name in place if name not in texts} | {f"{name}_{k}": word for name, words in texts.items() for k, word in enumerate(words)}
    rows = settled(rows, **{f"raw_{name}": number for name, number in numbers.items()})
    get = lambda name: F.col(f"raw_{name}")
    part_a = (F.col("msg_type") == 24) & (get("part") == 0)
    part_b = (F.col("msg_type") == 24) & (get("part") == 1)
    auxiliary = part_b & F.startswith(F.col("mmsi").cast("string"), F.lit("98"))
    only_b = lambda c: F.when(~part_a, c)
    size = lambda name: F.when(~part_a & ~auxiliary, get(name)).cast("int").alias(f"dimension_to_{name}")
    eta = eta_ms(get("eta_month"), get("eta_day"), get("eta_hour"), get("eta_minute"), F.lit(eta_year))
    rows = settled(rows, raw_ship_type=F.coalesce(only_b(get("ship_type")), F.lit(0)), eta_ms=eta)
    rows = settled(rows, **{f"raw_{name}": bits.text_of([get(f"{name}_{k}") for k in range(len(words))], place[name][0][2]) for name, words in texts.items()})
    return rows.select(
        *key_columns(parsed),
        F.when(F.col("msg_type") == 24, "Class B").otherwise("Class A").alias("ais_class"),
        bits.null_if(get("imo"), 0).alias("imo_number"), only_b(get("call_sign")).alias("call_sign"),
        F.when(~part_b, get("name")).alias("name"), labels.ship_type(get("ship_type")).alias("ship_type"),
        size("bow"), size("stern"), size("port"), size("starboard"), (get("draught") / 10.0).alias("draught_m"),
        get("destination").alias("destination"), "eta_ms", F.when(auxiliary, get("mothership")).alias("mothership_mmsi"), "station", "payload",
    )


def meteo_value(place: tuple) -> Column:
    offset, width, how, missing, added, divided = place
    raw = (bits.signed if how == "s" else bits.unsigned)(None, offset, width)
    if missing.startswith(">="):
        raw = F.when(raw < int(missing[2:]), raw)
    elif missing != "none":
        raw = bits.null_if(raw, int(missing))
    return (raw + added) / float(divided)


def meteo(parsed: DataFrame) -> DataFrame:
    long, short = layouts.meteo(31), layouts.meteo(11)
    rows = bits.with_words(parsed.where("kind = 'meteo'"), max(p[0] + p[1] for p in (*long.values(), *short.values()) if p))
    columns, place = [], {}
    for name in long:
        limit = {"longitude": 180, "latitude": 90}.get(name)
        value = F.when(F.col("fid") == 31, meteo_value(long[name]))
        if short[name]:
            value = value.otherwise(meteo_value(short[name]))
        if limit:
            place[name], value = F.when(F.abs(value) <= limit, value), F.col(name)
        columns.append((value == 1 if name in layouts.FLAGS else value).alias(name))
    told = settled(rows, **place).select(*key_columns(parsed), "dac", "fid", *columns, "station", "payload")
    return told.withColumn("hilbert", spatial.hilbert(F.col("latitude"), F.col("longitude")))


def binary(parsed: DataFrame) -> DataFrame:
    length = F.greatest(F.col("bit_length") - 56, F.lit(0)).cast("long")
    return parsed.where("kind = 'binary'").select(*key_columns(parsed), "dac", "fid", bits.hex_from(F.col("digits"), F.col("bit_length"), 56).alias("payload_hex"), length.alias("payload_bits"), "station", "payload")


def atons(parsed: DataFrame) -> DataFrame:
    place = layouts.by_type(layouts.ATON)
    get = lambda name: read(place, name)
    rows = settled(with_fields(parsed.where("kind = 'aton'"), place), latitude=degrees(get("lat"), 90), longitude=degrees(get("lon"), 180))
    told = rows.select(
        *key_columns(parsed), F.lit("AtoN").alias("ais_class"), labels.navaid_type(get("aid_type")).alias("aid_type"), get("name").alias("name"),
        F.lit(None).cast("string").alias("name_extension"), "latitude", "longitude",
        *[get(n).cast("int").alias(f"dimension_to_{n}") for n in ("bow", "stern", "port", "starboard")],
        (get("off_position") == 1).alias("off_position"), (get("virtual") == 1).alias("virtual_aid"), (get("assigned") == 1).alias("assigned_mode"),
        F.lit(False).alias("high_accuracy"), (get("raim") == 1).alias("raim"), "station", "payload",
    )
    return told.withColumn("hilbert", spatial.hilbert(F.col("latitude"), F.col("longitude")))


def other(parsed: DataFrame) -> DataFrame:
    named = F.when(F.coalesce("msg_type", F.lit(0)) == 0, "Unknown").otherwise(F.concat(F.lit("Type"), F.col("msg_type").cast("string")))
    return parsed.where("kind = 'other'").select(*carried(parsed), "station", named.alias("msg_type"), "payload")


def route(parsed: DataFrame, eta_year: int) -> dict[str, DataFrame]:
    """One table per kind of message."""
    return {"positions": positions(parsed), "statics": statics(parsed, eta_year), "meteo": meteo(parsed), "binary": binary(parsed), "atons": atons(parsed), "other": other(parsed)}


def stats(parsed: DataFrame) -> DataFrame:
    """Numbers of rows read, of each kind, incomplete and failed."""
    count = lambda k, name: F.count_if(F.col("kind") == k).alias(name)
    return parsed.agg(F.count("*").alias("rows_in"), *[count(k, f"{table}_out") for table, k in KINDS.items()], count("incomplete", "incomplete"), count("failed", "failed"))
