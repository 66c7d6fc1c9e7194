"""Queries of scans, line rules and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions import bits, labels, sentences, times
from seamark.jobs import config
from seamark.jobs import decode as jobs
from seamark.operators import decode, encode, partitions
from seamark.plans.base import EV, Tables, c, position_fields, query, scratch, sightings
from seamark.sources import lines


@query(r"""
select doc_id, cast(n - 1 as bigint) as line, payload from (
  select doc_id, unnest(string_split(text, chr(10))) as payload, unnest(generate_series(1, len(string_split(text, chr(10))))) as n from documents)
where payload <> '' and strlen(payload) < 65536""")
def scan_lines(t: Tables) -> DataFrame:
    """Framing of texts into lines, without empty and over-long ones."""
    cut = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "payload"))
    return lines.within_limit(cut.where("payload != ''")).select("doc_id", c("line").cast("long"), "payload")


@query("select doc_id, cast(strlen(text) as bigint) as bytes from documents where strlen(text) < 2000")
def max_line_filter(t: Tables) -> DataFrame:
    kept = lines.within_limit(t.documents.withColumnRenamed("text", "payload"), 2000)
    return kept.select("doc_id", F.octet_length("payload").cast("long").alias("bytes"))


@query(r"""
with cut as (select doc_id, string_split(text, chr(10)) as parts from documents),
kept as (select * from cut where list_max(list_transform(parts, lambda x: strlen(x))) < 2000)
select doc_id, cast(n - 1 as bigint) as line, payload from (select doc_id, unnest(parts) as payload, unnest(generate_series(1, len(parts))) as n from kept) where payload <> ''""")
def kafka_multiline(t: Tables) -> DataFrame:
    messages = t.documents.select("doc_id", c("text").alias("value"))
    return lines.message_lines(messages, 2000).select("doc_id", c("line").cast("long"), "payload")


@query(r"select page_id, regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]+?)(?:\.[^./]*)?$', 1) as label from pages")
def label_from_path(t: Tables) -> DataFrame:
    path = F.regexp_extract("url", "^([^?#]*)", 1)
    return t.pages.select("page_id", lines.stem(path).alias("label"))


@query("select 'a' as root, c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment from customer union all select 'b', s_suppkey, s_name, s_acctbal, null from supplier")
def union_sources(t: Tables) -> DataFrame:
    """Two roots of partitioned files, one of which lacks a column, read as one table."""
    a = t.customer.select(F.lit("a").alias("root"), c("c_custkey").alias("key"), c("c_name").alias("name"), c("c_acctbal").alias("balance"), c("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.lit("b").alias("root"), c("s_suppkey").alias("key"), c("s_name").alias("name"), c("s_acctbal").alias("balance"))
    roots = [scratch(t, f"root-{n}") for n in "ab"]
    for rows, root in zip((a, b), roots, strict=True):
        partitions.write_partitioned(rows.withColumn("ts_ms", c("key") % 4 * 86_400_000), root)
    return partitions.read_partitioned(t.spark, roots).select("root", "key", "name", "balance", "segment")


@query("select ts, event_type as source, props as payload from events where event_type = 'click' or value > 100")
def bronze_scan(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'click' or value > 100").select("ts", c("event_type").alias("source"), c("props").alias("payload"))


@query("select epoch_us(ts) // 1000 as arrival_ms, event_type as source, 'events' as file, event_id as line, props as payload, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day from events")
def bronze_roundtrip(t: Tables) -> DataFrame:
    """Lines written as bronze partitions and read as the decode job reads them."""
    root = scratch(t, "bronze")
    partitions.write_bronze(t.events.select(c("event_type").alias("source"), times.millis("ts").alias("ts_ms"), F.lit("events").alias("file"), c("event_id").alias("line"), c("props").alias("payload")), root)
    return jobs.bronze(t.spark, config.DecodeConfig((root,), root), None, 0)


@query("select doc_id, coalesce(case when doc_id % 3 = 0 then null else lang end, source) as source from documents")
def coalesce_source(t: Tables) -> DataFrame:
    own = F.when(c("doc_id") % 3 != 0, c("lang"))
    return t.documents.select("doc_id", F.coalesce(own, c("source")).alias("source"))


def tagged(t: Tables) -> DataFrame:
    """Sentences with tag blocks of several forms, by event_id modulo 5."""
    s = sightings(t)
    station, seconds = F.concat(F.lit("S"), c("user_id").cast("string")), F.expr("ts_ms div 1000")
    line = encode.sentence(position_fields())
    kinds = [encode.tagged(line, station, seconds), encode.tagged(line, station), encode.tagged(line, None, seconds), line, F.concat(F.lit("\\c:"), c("event_id").cast("string"))]
    found = kinds[4]
    for k in range(4):
        found = F.when(c("event_id") % 5 == k, kinds[k]).otherwise(found)
    return s.select("*", found.alias("payload"))


@query(f"""with {EV}, told as (
  select event_id, case event_id % 5 when 0 then 's:S' || user_id || ',c:' || ts_ms // 1000 when 1 then 's:S' || user_id when 2 then 'c:' || ts_ms // 1000 end as tags from ev)
select event_id, event_id % 5 <> 4 as has_sentence,
       coalesce(tags || '*' || lpad(upper(to_hex(list_reduce(list_transform(string_split(tags, ''), lambda x: ascii(x)), lambda a, b: xor(a, b)))), 2, '0'), '') as tag,
       cast(case event_id % 5 when 3 then 0 when 4 then 3 + length(cast(event_id as varchar)) else length(tags) + 5 end as bigint) as prefix_length
from told""")
def tag_split(t: Tables) -> DataFrame:
    p = c("payload")
    return tagged(t).select("event_id", sentences.tag_block(p).alias("tag"), F.startswith(sentences.after_tag_block(p), F.lit("!")).alias("has_sentence"), F.length(sentences.prefix(p)).cast("long").alias("prefix_length"))


@query(f"with {EV} select event_id, case when event_id % 5 < 2 then 'S' || user_id end as station from ev")
def tag_station(t: Tables) -> DataFrame:
    return tagged(t).select("event_id", sentences.tag_field(sentences.tag_block(c("payload")), "s").alias("station"))


@query(f"with {EV} select event_id, case event_id % 5 when 0 then ts_ms // 1000 * 1000 when 2 then ts_ms // 1000 * 1000 when 4 then nullif(event_id, 0) * 1000 end as tag_ms from ev")
def tag_ts(t: Tables) -> DataFrame:
    return tagged(t).select("event_id", sentences.tag_seconds_ms(sentences.prefix(c("payload"))).alias("tag_ms"))


@query("select event_id, case when event_id % 7 = 0 then null else epoch_ms(date_trunc('second', ts)) + event_id % 1000 end as capture_ms from events")
def pghp_ts(t: Tables) -> DataFrame:
    ms = F.when(c("event_id") % 7 == 0, 1000 + c("event_id") % 9).otherwise(c("event_id") % 1000)
    line = F.concat_ws(",", F.lit("$PGHP,1"), *[f("ts").cast("string") for f in (F.year, F.month, F.day, F.hour, F.minute, F.second)], ms.cast("string"), F.lit("298,,110,,1,26*19"))
    return t.events.select("event_id", sentences.capture_ms(line).alias("capture_ms"))


@query("""
select conv_id, turn, cast(n as int) as count, cast(turn + 1 as int) as number, case when n > 1 then '!AIVDM:' || n || ':' || conv_id % 10 || ':B' end as fragment_group
from (select *, count(*) over (partition by conv_id) as n from conversations)""")
def ais_meta(t: Tables) -> DataFrame:
    text = c("payload")
    return fragment_lines(t).select("conv_id", "turn", sentences.fragment_count(text).alias("count"), sentences.fragment_number(text).alias("number"), sentences.fragment_group(text).alias("fragment_group"))


def fragment_lines(t: Tables) -> DataFrame:
    """A conversation is a message and its turns are the fragments; the armor is the turn's length."""
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("conv_id"))
    armor = F.lpad(F.length("text").cast("string"), 8, "0")
    body = F.concat_ws(",", F.lit("AIVDM"), n.cast("string"), (c("turn") + 1).cast("string"), (c("conv_id") % 10).cast("string"), F.lit("B"), armor, F.lit("0"))
    return t.conversations.select("conv_id", "turn", "text", n.alias("n"), sentences.closed(body, "!").alias("payload"))


@query(f"with {EV} select event_id, case when event_id % 4 = 0 then 28 end as armor_length, case when event_id % 4 = 0 then 0 when event_id % 4 = 3 then null else 0 end as fill from ev")
def extract_payload(t: Tables) -> DataFrame:
    good = encode.sentence(position_fields())
    line = F.when(c("event_id") % 4 == 0, good).when(c("event_id") % 4 == 1, F.regexp_replace(good, "AIVDM", "GPGGA")).when(c("event_id") % 4 == 2, F.lit("!AIVDM,1,1,,A,,0*00")).otherwise(F.lit("$GPGGA,foo"))
    text = sightings(t).select("event_id", line.alias("line"))
    fill = F.when(F.size(F.split("line", ",")) >= 7, sentences.fill_bits(c("line")))
    return text.select("event_id", F.length(sentences.armored(c("line"))).alias("armor_length"), fill.alias("fill"))


@query("select c_custkey, lpad(upper(to_hex(list_reduce(list_transform(string_split(c_name, ''), lambda x: ascii(x)), lambda a, b: xor(a, b)))), 2, '0') as sum from customer")
def checksum(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", sentences.checksum(c("c_name")).alias("sum"))


@query(f"with {EV} select event_id, 42 as hex_length, 168 as bits, 'FFF' as ones from ev")
def dearmor(t: Tables) -> DataFrame:
    digits = bits.armored_hex(sentences.armored(c("line")))
    s = sightings(t).select("event_id", encode.sentence(position_fields()).alias("line"))
    return s.select("event_id", F.length(digits).alias("hex_length"), bits.bit_length(sentences.armored(c("line")), F.lit(0)).alias("bits"), bits.armored_hex(F.lit("ww")).alias("ones"))


def packed(t: Tables) -> DataFrame:
    coded, width = encode.message(position_fields())
    return sightings(t).select("event_id", bits.armored_hex(bits.armor_bits(coded, width)).alias("digits"))


@query(f"with {EV} select event_id, 1 as kind, mmsi, nav_raw, sog_raw, cog_raw, heading_raw, 0 as beyond from ev")
def bits_unsigned(t: Tables) -> DataFrame:
    u = lambda offset, width: bits.unsigned(c("digits"), offset, width)
    return packed(t).select("event_id", u(0, 6).cast("int").alias("kind"), u(8, 30).alias("mmsi"), u(38, 4).alias("nav_raw"), u(50, 10).alias("sog_raw"), u(116, 12).alias("cog_raw"), u(128, 9).alias("heading_raw"), u(400, 8).cast("int").alias("beyond"))


@query(f"with {EV} select event_id, rot_raw, lon_raw, lat_raw from ev")
def bits_signed(t: Tables) -> DataFrame:
    i = lambda offset, width: bits.signed(c("digits"), offset, width)
    return packed(t).select("event_id", i(42, 8).alias("rot_raw"), i(61, 28).alias("lon_raw"), i(89, 27).alias("lat_raw"))


@query(f"with {EV} select event_id, acc_raw = 1 as accuracy, raim_raw = 1 as raim from ev")
def bits_bool(t: Tables) -> DataFrame:
    return packed(t).select("event_id", bits.flag(c("digits"), 60).alias("accuracy"), bits.flag(c("digits"), 148).alias("raim"))


@query("select event_id, lpad(upper(to_hex(event_id % 65536)), 4, '0') || lpad(upper(to_hex(user_id % 256)), 2, '0') as payload_hex, 24 as payload_bits from events")
def hex_payload(t: Tables) -> DataFrame:
    from seamark.plans.base import binary_fields

    parsed = decode.parse(sightings(t).select("event_id", c("event_id").alias("line"), encode.sentence(binary_fields()).alias("payload")))
    return decode.binary(parsed).select(c("line").alias("event_id"), "payload_hex", c("payload_bits").cast("int"))


@query("select c_custkey, nullif(regexp_replace(case when c_custkey % 5 = 0 then '@@@ ' else '  ' || c_name || ' @@' end, '[ @]+$', ''), '') as name from customer")
def trim_ais(t: Tables) -> DataFrame:
    padded = F.when(c("c_custkey") % 5 == 0, "@@@ ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" @@")))
    return t.customer.select("c_custkey", bits.trimmed(padded).alias("name"))


def cases(code: str, names: tuple[str, ...], other: str) -> str:
    return f"case {code} " + " ".join(f"when {n} then '{x}'" for n, x in enumerate(names)) + f" else '{other}' end"


@query(f"select event_id, {cases('event_id % 18', labels.NAV_STATUS, '(notDefined)')} as nav_status from events")
def nav_status(t: Tables) -> DataFrame:
    return t.events.select("event_id", labels.nav_status(c("event_id") % 18).alias("nav_status"))


@query("select event_id, case " + " ".join(f"when event_id % 110 >= {first} then '{name}'" for first, name in reversed(labels.SHIP_TYPE)) + " end as ship_type from events")
def ship_type(t: Tables) -> DataFrame:
    return t.events.select("event_id", labels.ship_type(c("event_id") % 110).alias("ship_type"))


@query(f"select event_id, {cases('event_id % 35', labels.NAVAID_TYPE, 'not specified')} as aid_type from events")
def navaid_type(t: Tables) -> DataFrame:
    return t.events.select("event_id", labels.navaid_type(c("event_id") % 35).alias("aid_type"))


@query("select event_type, format('{:,}', count(*) * 1000) as shown, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') as newest from events group by event_type")
def format_count(t: Tables) -> DataFrame:
    newest = F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.events.groupBy("event_type").agg(F.format_number(F.count("*") * 1000, 0).alias("shown"), newest.alias("newest"))


@query("select event_id, ts, date_trunc('minute', ts) as minute_start, date_trunc('hour', ts) as hour_start, date_trunc('day', ts) as day_start, date_trunc('month', ts) as month_start, date_trunc('year', ts) as year_start, date_trunc('month', ts) + interval 1 month as month_end, date_trunc('year', ts) + interval 1 year as year_end, date_trunc('day', ts) + interval 1 day as day_end from events")
def period_bounds(t: Tables) -> DataFrame:
    timed = t.events.select("event_id", "ts", times.millis("ts").alias("ms"))
    return timed.select("event_id", "ts", *[times.period_start(c("ms"), g).alias(f"{g}_start") for g in times.GRAINS], *[times.period_end(c("ms"), g).alias(f"{g}_end") for g in ("day", "month", "year")])
