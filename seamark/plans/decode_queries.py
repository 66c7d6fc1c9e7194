"""Queries of the sentence decoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions import hexagons, labels, sentences, spatial
from seamark.functions.settle import settled
from seamark.operators import decode, encode, layouts
from seamark.plans import base
from seamark.plans.base import ETA_YEAR, EV, KIND_SQL, TYPE_SQL, Tables, c, query, sightings
from seamark.plans.text_queries import cases


def stored_lines(t: Tables, fields: list) -> DataFrame:
    return settled(sightings(t), line=c("event_id"), payload=encode.sentence(fields)).select("ts_ms", "line", "payload")


def parsed(t: Tables, fields: list) -> DataFrame:
    return decode.parse(stored_lines(t, fields))


@query(f"select event_id, cast({TYPE_SQL} as int) as msg_type from events")
def peek_type(t: Tables) -> DataFrame:
    return decode.parse(base.mixed_lines(t)).select("event_id", "msg_type")


@query(f"select {KIND_SQL} as kind, count(*) as n from events group by all")
def decode_kinds(t: Tables) -> DataFrame:
    return decode.parse(base.mixed_lines(t)).groupBy("kind").agg(F.count("*").alias("n"))


#: Position columns that all reports share.
PLACE_SQL = "lat_raw / 600000.0 as latitude, lon_raw / 600000.0 as longitude"


@query(f"""with {EV} select event_id, mmsi, 'Class A' as ais_class, {PLACE_SQL}, case when sog_raw <> 1023 then sog_raw / 10.0 end as sog_knots,
cog_raw / 10.0 as cog, cast(nullif(heading_raw, 511) as double) as heading_true, cast(nullif(rot_raw, -128) as double) as rot,
{cases('nav_raw', labels.NAV_STATUS, '(notDefined)')} as nav_status, acc_raw = 1 as high_accuracy, raim_raw = 1 as raim,
case man_raw when 1 then false when 2 then true end as special_manoeuvre from ev""")
def position_decode(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, base.position_fields()))
    return rows.select(c("line").alias("event_id"), "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "cog", "heading_true", "rot", "nav_status", "high_accuracy", "raim", "special_manoeuvre")


@query(f"with {EV} select event_id, 18 as msg_type, mmsi, 'Class B' as ais_class, {PLACE_SQL}, sog_raw / 10.0 as sog_knots, cast(nullif(heading_raw, 511) as double) as heading_true, raim_raw = 1 as raim from ev")
def class_b_decode(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, base.class_b_fields()))
    return rows.select(c("line").alias("event_id"), "msg_type", "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "heading_true", "raim")


def long_range_fields() -> list:
    return [(27, 6), (0, 2), (c("mmsi"), 30), (c("acc_raw"), 1), (c("raim_raw"), 1), (c("nav_raw"), 4), (F.expr("lon_raw div 1000"), 18), (F.expr("lat_raw div 1000"), 17), (c("event_id") % 64, 6), (c("event_id") % 512, 9), (0, 2)]


@query(f"""with {EV} select event_id, 27 as msg_type, mmsi, 'Class A' as ais_class, lat_raw // 1000 / 600.0 as latitude, lon_raw // 1000 / 600.0 as longitude,
cast(nullif(event_id % 64, 63) as double) as sog_knots, cast(nullif(event_id % 512, 511) as double) as cog, {cases('nav_raw', labels.NAV_STATUS, '(notDefined)')} as nav_status, acc_raw = 1 as high_accuracy, raim_raw = 1 as raim from ev""")
def long_range_decode(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, long_range_fields()))
    return rows.select(c("line").alias("event_id"), "msg_type", "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "cog", "nav_status", "high_accuracy", "raim")


def extended_fields() -> list:
    return [(19, 6), *base.class_b_fields()[1:10], (0, 60), (0, 60), (0, 52), (c("raim_raw"), 1), (0, 6)]


@query(f"with {EV} select event_id, 19 as msg_type, mmsi, 'Class B' as ais_class, {PLACE_SQL}, sog_raw / 10.0 as sog_knots, cog_raw / 10.0 as cog, cast(nullif(heading_raw, 511) as double) as heading_true, acc_raw = 1 as high_accuracy, raim_raw = 1 as raim from ev")
def class_b_extended(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, extended_fields()))
    return rows.select(c("line").alias("event_id"), "msg_type", "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "cog", "heading_true", "high_accuracy", "raim")


@query()
def h3_cell(t: Tables) -> DataFrame:
    """The cell of each decoded position, as a number and as it is written, and the coarser one that holds it."""
    rows = decode.positions(parsed(t, base.position_fields()))
    cell, coarse = (hexagons.h3(c("latitude"), c("longitude"), r) for r in (10, 5))
    return rows.select(c("line").alias("event_id"), "latitude", "longitude", cell.alias("h3"), coarse.alias("h3_5")).withColumn("h3_text", F.lower(F.hex("h3")))


@query(f"with {EV} select event_id, mmsi, 'Class A' as ais_class, {PLACE_SQL}, cast(nullif(sog_raw, 1023) as double) as sog_knots, cog_raw / 10.0 as cog, cast(nullif(event_id % 4096, 4095) as double) as altitude_m, cast(null as double) as heading_true, 'under way using engine' as nav_status, acc_raw = 1 as high_accuracy, raim_raw = 1 as raim from ev")
def sar_decode(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, base.sar_fields()))
    return rows.select(c("line").alias("event_id"), "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "cog", "altitude_m", "heading_true", "nav_status", "high_accuracy", "raim")


@query(f"with {EV} select event_id, 4 as msg_type, mmsi, 'Base Station' as ais_class, {PLACE_SQL}, cast(null as double) as sog_knots, '' as nav_status, acc_raw = 1 as high_accuracy, raim_raw = 1 as raim from ev")
def base_station(t: Tables) -> DataFrame:
    rows = decode.positions(parsed(t, base.base_fields()))
    return rows.select(c("line").alias("event_id"), "msg_type", "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "nav_status", "high_accuracy", "raim")


def ships(t: Tables) -> DataFrame:
    """Static reports of customers. Rows are dealt out first: 900,000 are few bytes, which one task reads, but much work."""
    fields = base.static_fields(c("c_name"), F.concat(F.lit("C"), (c("c_custkey") % 100000).cast("string")), c("c_mktsegment"), c("c_custkey"))
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    dealt = rows.repartition(max(3 * t.spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()))
    written = dealt.select(c("c_custkey").alias("line"), F.lit(0).cast("long").alias("ts_ms"), encode.unclosed(fields).alias("body"))
    return decode.parse(settled(written, payload=sentences.closed(c("body"), "!")).drop("body"))


SHIP_SQL = "case " + " ".join(f"when c_custkey % 100 >= {first} then '{name}'" for first, name in reversed(labels.SHIP_TYPE)) + " end"
#: Arrival from month c % 13, day c % 29, hour c % 25, minute c % 61 of the year; null for month or day 0 and for days that the month lacks.
ETA_SQL = f"""case when c_custkey % 13 = 0 or c_custkey % 29 = 0 then null else
  epoch_ms(try_cast('{ETA_YEAR}-' || lpad(cast(c_custkey % 13 as varchar), 2, '0') || '-' || lpad(cast(c_custkey % 29 as varchar), 2, '0') as timestamp))
  + least(c_custkey % 25, 23) * 3600000 + least(c_custkey % 61, 59) * 60000 end"""


@query(f"""select c_custkey, 200000000 + c_custkey as mmsi, 5 as msg_type, 'Class A' as ais_class, nullif(c_custkey % 9999999, 0) as imo_number,
'C' || c_custkey % 100000 as call_sign, upper(c_name) as name, {SHIP_SQL} as ship_type, upper(c_mktsegment) as destination from customer""")
def static_decode(t: Tables) -> DataFrame:
    rows = decode.statics(ships(t), ETA_YEAR)
    return rows.select(c("line").alias("c_custkey"), "mmsi", "msg_type", "ais_class", "imo_number", "call_sign", "name", "ship_type", "destination")


@query(f"""select c_custkey, cast(c_custkey % 512 as int) as dimension_to_bow, cast(c_custkey % 511 as int) as dimension_to_stern, cast(c_custkey % 64 as int) as dimension_to_port,
cast(c_custkey % 63 as int) as dimension_to_starboard, c_custkey % 256 / 10.0 as draught_m, {ETA_SQL} as eta_ms from customer""")
def static_fields(t: Tables) -> DataFrame:
    rows = decode.statics(ships(t), ETA_YEAR)
    return rows.select(c("line").alias("c_custkey"), "dimension_to_bow", "dimension_to_stern", "dimension_to_port", "dimension_to_starboard", "draught_m", "eta_ms")


@query(f"select c_custkey, {ETA_SQL} as eta_ms from customer")
def eta(t: Tables) -> DataFrame:
    k = c("c_custkey")
    return t.customer.select("c_custkey", decode.eta_ms(k % 13, k % 29, k % 25, k % 61, F.lit(ETA_YEAR)).alias("eta_ms"))


@query("select s_suppkey, s_suppkey % 2 as part, case when s_suppkey % 2 = 0 then upper(s_name) end as name, case when s_suppkey % 2 = 1 then 'S' || s_suppkey end as call_sign, case when s_suppkey % 2 = 1 then cast(s_suppkey % 500 as int) end as bow from supplier")
def static_parts(t: Tables) -> DataFrame:
    """Parts A and B of type 24."""
    k = c("s_suppkey")
    a = encode.sentence([(24, 6), (0, 2), (300000000 + k, 30), (0, 2), (c("s_name"), -20)])
    b = encode.sentence([(24, 6), (0, 2), (300000000 + k, 30), (1, 2), (k % 100, 8), (0, 42), (F.concat(F.lit("S"), k.cast("string")), -7), (k % 500, 9), (k % 400, 9), (1, 6), (2, 6), (0, 6)])
    rows = decode.statics(decode.parse(t.supplier.select(k.alias("line"), F.when(k % 2 == 0, a).otherwise(b).alias("payload"))), ETA_YEAR)
    return rows.select(c("line").alias("s_suppkey"), (c("line") % 2).alias("part"), "name", "call_sign", c("dimension_to_bow").alias("bow"))


@query(f"""with {EV} select event_id, mmsi, {cases('event_id % 32', labels.NAVAID_TYPE, 'not specified')} as aid_type, 'BUOY ' || event_id as name, {PLACE_SQL},
cast(event_id % 512 as int) as dimension_to_bow, cast(event_id % 63 as int) as dimension_to_starboard, acc_raw = 1 as off_position, man_raw % 2 = 1 as virtual_aid, acc_raw = 1 as assigned_mode,
false as high_accuracy, raim_raw = 1 as raim from ev""")
def aton_decode(t: Tables) -> DataFrame:
    rows = decode.atons(parsed(t, base.aton_fields()))
    return rows.select(c("line").alias("event_id"), "mmsi", "aid_type", "name", "latitude", "longitude", "dimension_to_bow", "dimension_to_starboard", "off_position", "virtual_aid", "assigned_mode", "high_accuracy", "raim")


@query(f"with {EV} select event_id, case event_id % 3 when 0 then 'meteo' when 1 then 'meteo' else 'binary' end as kind, 1 as dac, cast(case event_id % 3 when 0 then 31 when 1 then 11 else 22 end as int) as fid, cast(case event_id % 3 when 0 then 360 when 1 then 352 else 80 end as int) as bits from ev")
def type8_route(t: Tables) -> DataFrame:
    s = sightings(t)
    line = F.when(c("event_id") % 3 == 0, encode.sentence(base.meteo_fields(31))).when(c("event_id") % 3 == 1, encode.sentence(base.meteo_fields(11))).otherwise(encode.sentence(base.binary_fields()))
    rows = decode.parse(s.select("event_id", line.alias("payload")))
    return rows.select("event_id", "kind", "dac", "fid", c("bit_length").cast("int").alias("bits"))


def meteo_sql(identifier: int) -> str:
    """The value of each field by its formula, from the integer that was written."""
    written, offset, sources = base.METEO_31 if identifier == 31 else base.METEO_11, 56, {}
    for width, expression in written:
        sources[offset] = f"({expression})"
        offset += width
    columns = []
    for name, place in layouts.meteo(identifier).items():
        if place is None:
            columns.append(f"cast(null as {'boolean' if name in layouts.FLAGS else 'double'}) as {name}")
            continue
        at, width, _, missing, added, divided = place
        raw = sources[at]
        value = f"({raw} + {added}) / {divided}.0"
        if name in layouts.FLAGS:
            columns.append(f"{raw} = 1 as {name}")
            continue
        if missing.startswith(">="):
            value = f"case when {raw} < {missing[2:]} then {value} end"
        elif missing != "none":
            value = f"case when {raw} <> {missing} then {value} end"
        columns.append(f"{value} as {name}")
    return f"with {EV} select event_id, mmsi, {', '.join(columns)} from ev"


def meteo_rows(t: Tables, identifier: int) -> DataFrame:
    rows = decode.meteo(parsed(t, base.meteo_fields(identifier)))
    return rows.select(c("line").alias("event_id"), "mmsi", *layouts.meteo(31))


@query(meteo_sql(31))
def meteo_fid31(t: Tables) -> DataFrame:
    return meteo_rows(t, 31)


@query(meteo_sql(11))
def meteo_fid11(t: Tables) -> DataFrame:
    return meteo_rows(t, 11)


@query("select event_id, 'feed' || user_id % 3 as source, 'STN' || user_id % 7 as station, 'Type14' as msg_type from events where event_id % 10 = 7")
def other_rows(t: Tables) -> DataFrame:
    return decode.other(decode.parse(base.mixed_lines(t))).select(c("line").alias("event_id"), "source", "station", "msg_type")


@query("select 'feed' || user_id % 3 as source, count(*) as failed from events where event_id % 10 > 7 group by all")
def failed_counts(t: Tables) -> DataFrame:
    return decode.parse(base.mixed_lines(t)).where("kind = 'failed'").groupBy("source").agg(F.count("*").alias("failed"))


@query(f"select {TYPE_SQL} as msg_type, case event_id % 10 when 2 then 'Class B' when 3 then 'Base Station' else 'Class A' end as ais_class, count(*) as n from events where event_id % 10 < 5 group by all")
def msg_type_default(t: Tables) -> DataFrame:
    return decode.positions(decode.parse(base.mixed_lines(t))).groupBy("msg_type", "ais_class").agg(F.count("*").alias("n"))


#: Place on the curve from the cell numbers x and y, one bit after the other.
HILBERT_SQL = """list_reduce(
  [struct_pack(d := 0::bigint, x := least(cast(floor((longitude + 180.0) / 360.0 * 2147483648.0) as bigint), 2147483647), y := least(cast(floor((latitude + 90.0) / 180.0 * 2147483648.0) as bigint), 2147483647), s := 1073741824::bigint)]
  || list_transform(range(31), lambda k: struct_pack(d := 0::bigint, x := 0::bigint, y := 0::bigint, s := 0::bigint)),
  lambda a, b: struct_pack(
    d := a.d + a.s * a.s * xor(3 * (case when (a.x & a.s) > 0 then 1 else 0 end), case when (a.y & a.s) > 0 then 1 else 0 end),
    x := case when (a.y & a.s) > 0 then a.x when (a.x & a.s) > 0 then 2147483647 - a.y else a.y end,
    y := case when (a.y & a.s) > 0 then a.y when (a.x & a.s) > 0 then 2147483647 - a.x else a.x end,
    s := a.s // 2)).d"""


@query(f"with {EV}, placed as (select event_id, {PLACE_SQL} from ev) select event_id, {HILBERT_SQL} as hilbert from placed")
def hilbert(t: Tables) -> DataFrame:
    s = sightings(t)
    return s.select("event_id", spatial.hilbert(c("lat_raw") / 600000.0, c("lon_raw") / 600000.0).alias("hilbert"))


@query(f"with {EV} select count(*) as rows_in, count_if(event_id % 10 < 5) as positions_out, 0::bigint as statics_out, 0::bigint as meteo_out, count_if(event_id % 10 = 5) as binary_out, count_if(event_id % 10 = 6) as atons_out, count_if(event_id % 10 = 7) as other_out, 0::bigint as incomplete, count_if(event_id % 10 > 7) as failed from ev")
def parse_stats(t: Tables) -> DataFrame:
    return decode.stats(decode.parse(base.mixed_lines(t)))
