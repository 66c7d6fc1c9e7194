"""Published sentences, and what must come out of them."""

import random

import pytest
from pyspark.sql import functions as F

from seamark.functions import bits, sentences
from seamark.operators import decode, encode, ordering
from seamark.plans import base, decode_queries  # noqa: F401  registers the queries

POSITION = "!AIVDM,1,1,,A,15RTgt0PAso;90TKcjM8h6g208CQ,0*4A"
PART_1 = "!AIVDM,2,1,3,B,55P5TL01VIaAL@7WKO@mBplU@<PDhh000000001S;AJ::4A80?4i@E53,0*3E"
PART_2 = "!AIVDM,2,2,3,B,1@0000000000000,2*55"
CAPTURE = "$PGHP,1,2013,1,9,4,37,45,298,,110,,1,26*19"


def lines(spark, payloads, source="x"):
    return spark.createDataFrame([(source, i, 1000 + i, p) for i, p in enumerate(payloads)], "source string, line long, arrival_ms long, payload string")


def test_position(spark):
    rows = decode.positions(decode.parse(lines(spark, [POSITION, f"\\s:AIS_NOR,c:1700000000*5E\\{POSITION}"]))).orderBy("line").collect()
    assert [r.mmsi for r in rows] == [371798000] * 2
    assert rows[0].latitude == pytest.approx(48.3816333, abs=1e-6) and rows[0].longitude == pytest.approx(-123.3953833, abs=1e-6)
    assert rows[0].station is None and rows[1].station == "AIS_NOR"


def test_two_parts(spark):
    timed = ordering.resolve_timestamps(lines(spark, [PART_1, PART_2]))
    [row] = decode.statics(decode.parse(ordering.reassemble(timed)), 2024).collect()
    assert (row.mmsi, row.name, row.call_sign, row.destination) == (369190000, "MT.MITCHELL", "WDA9674", "SEATTLE")


def test_bad_lines_fail(spark):
    kinds = decode.parse(lines(spark, ["not a sentence at all", "", "$GPGGA,foo", "!AIVDM,1,1,,A,,0*00", CAPTURE, PART_1, "!AIVDM,1,1,,A,~~,0*00"])).orderBy("line").select("kind").collect()
    assert [k[0] for k in kinds] == ["failed"] * 5 + ["incomplete", "failed"]


def test_text_functions(spark):
    p = F.col("payload")
    got = lines(spark, [CAPTURE, "\\c:12345", "\\s:AIS_NOR,c:1241544035*1D\\!AIVDM,1,1,,B,15N4,0*00", "\\c:0*00\\!AIVDM"]).orderBy("line")
    told = got.select(sentences.capture_ms(sentences.sentence(p)), sentences.tag_block(p), sentences.tag_seconds_ms(sentences.prefix(p)), sentences.tag_field(sentences.tag_block(p), "s")).collect()
    assert told[0][0] == 1357706265298 and told[1][1] == "" and told[1][2] == 12345000
    assert told[2][2] == 1241544035000 and told[2][3] == "AIS_NOR" and told[3][2] is None


def test_checksums(spark):
    bodies = [s[1:-3] for s in (POSITION, PART_1, PART_2)]
    got = spark.createDataFrame([(b,) for b in bodies], "b string").select(sentences.checksum(F.col("b"))).collect()
    assert [g[0] for g in got] == ["4A", "3E", "55"]


def test_bits_against_integers(spark):
    """Numbers of random widths, packed by arithmetic on one large integer."""
    rng = random.Random(3)
    for _ in range(5):
        widths = [rng.randint(1, 30) for _ in range(8)]
        values = [rng.randrange(1 << w) for w in widths]
        whole = 0
        for v, w in zip(values, widths, strict=True):
            whole = whole << w | v
        total = sum(widths)
        pad = -total % 6
        armor = "".join(bits.CANONICAL[(whole << pad) >> 6 * k & 63] for k in reversed(range((total + pad) // 6)))
        df = spark.createDataFrame([(armor,)], "a string").select(bits.armored_hex(F.col("a")).alias("d"))
        offset, columns = 0, []
        for k, w in enumerate(widths):
            columns += [bits.unsigned(F.col("d"), offset, w).alias(f"u{k}"), bits.signed(F.col("d"), offset, w).alias(f"s{k}")]
            offset += w
        row = df.select(*columns, bits.unsigned(F.col("d"), total + 200, 8).alias("beyond")).first()
        assert [row[f"u{k}"] for k in range(8)] == values and row["beyond"] == 0
        assert [row[f"s{k}"] for k in range(8)] == [v - (1 << w) if v >> (w - 1) else v for v, w in zip(values, widths, strict=True)]


def test_type_8(spark):
    short = encode.sentence([(8, 6), (0, 2), (F.lit(2655619), 30), (0, 2), (1, 10), (31, 6), (F.lit(0xABCDE), 20)])
    [row] = decode.binary(decode.parse(spark.range(1).select(short.alias("payload")))).collect()
    assert (row.mmsi, row.dac, row.fid, row.payload_bits, row.payload_hex) == (2655619, 1, 31, 20, "ABCDE")


def test_sentence_as_bits(spark):
    """A sentence's armor is that of its bits in a row, whatever the widths, and for texts that six bits don't hold."""
    rng, rows = random.Random(5), []
    for text in ("", "abc", "A@ ", "ÉTOILE {x}", "Straße", "twenty characters and more", None):
        rows += [(rng.randrange(1 << 30), -rng.randrange(1, 1 << 27), text) for _ in range(4)] + [(None, 1, text)]
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    fields = [(5, 6), (b, 28), (a, 30), (1, 1), (t, -7), (a % 8, 3), (0, 60), (t, -20), (b, 33), (3, 2), (t, -5), (a, 30)]
    coded, width = encode.message(fields)
    frame = spark.createDataFrame(rows, "a long, b long, t string")
    got = frame.select(F.get(F.split(encode.sentence(fields), ","), F.lit(5)).alias("one"), bits.armor_bits(coded, width).alias("other")).collect()
    assert [r.one for r in got] == [r.other for r in got] and sum(r.one is None for r in got) == 11


def test_sentence_holds_a_field_once(spark):
    """Static reports have 18 groups of four characters; each used to hold all fields, and a text once for four of its letters."""
    fields = base.static_fields(F.col("name"), F.lit("C"), F.lit("D"), F.lit(7).cast("long"))
    frame = spark.createDataFrame([("x",)], "name string").select(encode.sentence(fields).alias("line"))
    assert 5 <= frame._jdf.queryExecution().analyzed().toString().count("upper(name#") <= 10


@pytest.mark.parametrize("name", ["static_decode", "static_fields"])
def test_static_methods_are_compiled(spark, sf_dir, name):
    """Java interprets methods of over 8000 bytes; statics were one of 29,785."""
    tables = base.Tables(spark, sf_dir)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frames = [base.QUERIES[name](spark, sf_dir), decode.statics(decode.parse(tables.events.select(F.col("event_id").alias("line"), F.col("event_type").alias("payload"))), 2024)]
        made = [frame._jdf.queryExecution().debug().codegenToSeq() for frame in frames]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [some.apply(k)._3().maxMethodCodeSize() for some in made for k in range(some.size())]
    assert sizes and 0 < max(sizes) < 8000
