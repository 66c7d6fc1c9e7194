"""Queries of the JSON feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions import labels
from seamark.functions.settle import settled
from seamark.operators import decode, encode, jsonfeed
from seamark.plans.base import ETA_YEAR, EV, Tables, c, position_fields, query, sightings
from seamark.plans.decode_queries import ETA_SQL, PLACE_SQL, SHIP_SQL
from seamark.plans.text_queries import cases


def envelope(name: str, body: Column) -> Column:
    meta = F.struct(c("mmsi").alias("MMSI"), F.lit("SHIP").alias("ShipName"))
    return F.to_json(F.struct(F.lit(name).alias("MessageType"), meta.alias("MetaData"), F.struct(body.alias(name)).alias("Message")))


def common(number: int) -> list[Column]:
    return [F.lit(number).alias("MessageID"), c("mmsi").alias("UserID"), (c("lat_raw") / 600000.0).alias("Latitude"), (c("lon_raw") / 600000.0).alias("Longitude"), (c("acc_raw") == 1).alias("PositionAccuracy"), (c("raim_raw") == 1).alias("Raim")]


def position_body() -> Column:
    """Without a user id for every ninth event, and with a rotation out of range for every seventh."""
    moving = [(c("sog_raw") / 10.0).alias("Sog"), (c("cog_raw") / 10.0).alias("Cog"), c("heading_raw").alias("TrueHeading"), F.when(c("event_id") % 7 == 3, 300).otherwise(c("rot_raw")).alias("RateOfTurn"), c("nav_raw").alias("NavigationalStatus"), c("man_raw").alias("SpecialManoeuvreIndicator")]
    fields = [F.when(c("event_id") % 9 != 0, c("mmsi")).alias("UserID") if k == 1 else x for k, x in enumerate(common(1))]
    return F.struct(*fields, *moving)


def feed(t: Tables) -> DataFrame:
    """Messages of five types by event_id modulo 5, one of them unknown, and one line that isn't JSON in 50."""
    which = c("event_id") % 5
    aid = F.struct(*common(21), (c("event_id") % 32).alias("Type"), F.concat(F.lit("BUOY "), c("event_id").cast("string"), F.lit("@@ ")).alias("Name"), (c("acc_raw") == 0).alias("OffPosition"))
    line = F.when(which == 0, envelope("PositionReport", position_body()))
    line = line.when(which == 1, envelope("StandardClassBPositionReport", F.struct(*common(18), (c("sog_raw") / 10.0).alias("Sog"), c("heading_raw").alias("TrueHeading"))))
    line = line.when(which == 2, envelope("BaseStationReport", F.struct(*common(4)))).when(which == 3, envelope("AidsToNavigationReport", aid)).otherwise(envelope("SafetyBroadcastMessage", F.struct(*common(14))))
    return settled(sightings(t), payload=F.when(c("event_id") % 50 == 49, "{broken").otherwise(line), line=c("event_id"))


FAILED_SQL = "(event_id % 50 = 49 or (event_id % 5 = 0 and (event_id % 9 = 0 or event_id % 7 = 3)))"


@query(f"select case when {FAILED_SQL} then 'failed' when event_id % 5 < 3 then 'position' when event_id % 5 = 3 then 'aton' else 'other' end as kind, count(*) as n from events group by all")
def json_kinds(t: Tables) -> DataFrame:
    return jsonfeed.parse(feed(t)).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""with {EV} select event_id, mmsi, case when event_id % 5 = 0 then 'Class A' else 'Class B' end as ais_class, {PLACE_SQL}, sog_raw / 10.0 as sog_knots, cast(nullif(heading_raw, 511) as double) as heading_true,
case when event_id % 5 = 0 then cast(nullif(rot_raw, -128) as double) end as rot, case when event_id % 5 = 0 then {cases('nav_raw', labels.NAV_STATUS, '(notDefined)')} else '(notDefined)' end as nav_status,
case when event_id % 5 = 0 then case man_raw when 1 then false when 2 then true end end as special_manoeuvre from ev where event_id % 5 < 2 and not {FAILED_SQL}""")
def json_positions(t: Tables) -> DataFrame:
    rows = jsonfeed.positions(jsonfeed.parse(feed(t))).where("msg_type in (1, 18)")
    return rows.select(c("line").alias("event_id"), "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "heading_true", "rot", "nav_status", "special_manoeuvre")


@query(f"with {EV} select event_id, cast(event_id % 5 as int) as kind, mmsi, {PLACE_SQL}, case when event_id % 5 = 3 then 'BUOY ' || event_id end as name, case when event_id % 5 = 3 then {cases('event_id % 32', labels.NAVAID_TYPE, 'not specified')} end as aid_type, acc_raw = 1 as high_accuracy from ev where event_id % 5 in (2, 3)")
def json_misc(t: Tables) -> DataFrame:
    parsed = jsonfeed.parse(feed(t))
    places = ["mmsi", "latitude", "longitude"]
    base = jsonfeed.positions(parsed).where("msg_type = 4").select(c("line").alias("event_id"), F.lit(2).alias("kind"), *places, F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("aid_type"), "high_accuracy")
    aids = jsonfeed.atons(parsed).select(c("line").alias("event_id"), F.lit(3).alias("kind"), *places, "name", "aid_type", "high_accuracy")
    return base.unionByName(aids)


def rarer(t: Tables) -> DataFrame:
    """By event_id modulo 3 an extended class B report, one of a search aircraft, and a position whose fields lie in the message itself."""
    moving = [(c("sog_raw") / 10.0).alias("Sog"), (c("cog_raw") / 10.0).alias("Cog")]
    extended = envelope("ExtendedClassBPositionReport", F.struct(*common(19), *moving, c("heading_raw").alias("TrueHeading")))
    aircraft = envelope("StandardSearchAndRescueAircraftReport", F.struct(*common(9), *moving, (c("event_id") % 4096).cast("double").alias("Altitude")))
    bare = F.to_json(F.struct(F.lit("PositionReport").alias("MessageType"), F.struct(c("mmsi").alias("MMSI")).alias("MetaData"), F.struct(*common(1), *moving, c("nav_raw").alias("NavigationalStatus")).alias("Message")))
    which = c("event_id") % 3
    return settled(sightings(t), payload=F.when(which == 0, extended).when(which == 1, aircraft).otherwise(bare), line=c("event_id"))


@query(f"""with {EV} select event_id, cast(case event_id % 3 when 0 then 19 when 1 then 9 else 1 end as int) as msg_type, mmsi, case when event_id % 3 = 0 then 'Class B' else 'Class A' end as ais_class, {PLACE_SQL},
sog_raw / 10.0 as sog_knots, cog_raw / 10.0 as cog, case when event_id % 3 = 0 then cast(nullif(heading_raw, 511) as double) end as heading_true, case when event_id % 3 = 1 then cast(event_id % 4096 as double) end as altitude_m,
case event_id % 3 when 0 then '(notDefined)' when 1 then 'under way using engine' else {cases('nav_raw', labels.NAV_STATUS, '(notDefined)')} end as nav_status, raim_raw = 1 as raim from ev""")
def json_rarer(t: Tables) -> DataFrame:
    rows = jsonfeed.positions(jsonfeed.parse(rarer(t)))
    return rows.select(c("line").alias("event_id"), "msg_type", "mmsi", "ais_class", "latitude", "longitude", "sog_knots", "cog", "heading_true", "altitude_m", "nav_status", "raim")


@query(f"select event_id from events where {FAILED_SQL}")
def json_failed(t: Tables) -> DataFrame:
    return jsonfeed.parse(feed(t)).where("kind = 'failed'").select("event_id")


def ships(t: Tables) -> DataFrame:
    k = c("c_custkey")
    sizes = F.struct((k % 512).alias("A"), (k % 511).alias("B"), (k % 64).alias("C"), (k % 63).alias("D"))
    eta = F.struct((k % 13).alias("Month"), (k % 29).alias("Day"), (k % 25).alias("Hour"), (k % 61).alias("Minute"))
    body = F.struct(F.lit(5).alias("MessageID"), c("mmsi").alias("UserID"), (k % 9999999).alias("ImoNumber"), F.concat(c("c_name"), F.lit(" @@")).alias("Name"), (k % 100).alias("Type"), sizes.alias("Dimension"), eta.alias("Eta"), (k % 256 / 10.0).alias("MaximumStaticDraught"), c("c_mktsegment").alias("Destination"))
    rows = t.customer.withColumn("mmsi", k + 200000000)
    return settled(rows, payload=envelope("ShipStaticData", body), line=k)


@query(f"select c_custkey, 200000000 + c_custkey as mmsi, 'Class A' as ais_class, nullif(c_custkey % 9999999, 0) as imo_number, c_name as name, {SHIP_SQL} as ship_type, cast(c_custkey % 512 as int) as bow, c_custkey % 256 / 10.0 as draught_m, c_mktsegment as destination, {ETA_SQL} as eta_ms from customer")
def json_statics(t: Tables) -> DataFrame:
    rows = jsonfeed.statics(jsonfeed.parse(ships(t)), ETA_YEAR)
    return rows.select(c("line").alias("c_custkey"), "mmsi", "ais_class", "imo_number", "name", "ship_type", c("dimension_to_bow").alias("bow"), "draught_m", "destination", "eta_ms")


@query("select s_suppkey, case when s_suppkey % 2 = 0 then s_name end as name, case when s_suppkey % 2 = 1 then 'CALL' || s_suppkey end as call_sign, case when s_suppkey % 2 = 1 then case when s_suppkey % 4 = 1 then 'tug' else 'pilot' end else '' end as ship_type from supplier")
def json_static_parts(t: Tables) -> DataFrame:
    k = c("s_suppkey")
    report_b = F.struct(F.concat(F.lit("CALL"), k.cast("string"), F.lit("@")).alias("CallSign"), F.when(k % 4 == 1, 52).otherwise(50).alias("ShipType"))
    body = F.struct(F.lit(24).alias("MessageID"), c("mmsi").alias("UserID"), (k % 2 == 1).alias("PartNumber"), F.struct(c("s_name").alias("Name")).alias("ReportA"), report_b.alias("ReportB"))
    rows = settled(t.supplier.withColumn("mmsi", k + 300000000), payload=envelope("StaticDataReport", body), line=k)
    return jsonfeed.statics(jsonfeed.parse(rows), ETA_YEAR).select(c("line").alias("s_suppkey"), "name", "call_sign", "ship_type")


@query(f"with {EV} select 'json' as feed, count(*) as n, count(distinct mmsi) as ships from ev where event_id % 5 < 3 and not {FAILED_SQL} union all select 'sentences', count(*), count(distinct mmsi) from ev")
def union_decoders(t: Tables) -> DataFrame:
    """Both decoders' rows as one table."""
    json = jsonfeed.positions(jsonfeed.parse(feed(t))).withColumn("feed", F.lit("json"))
    lines = settled(sightings(t), line=c("event_id"), payload=encode.sentence(position_fields())).select("ts_ms", "line", "payload")
    both = json.unionByName(decode.positions(decode.parse(lines)).withColumn("feed", F.lit("sentences")), allowMissingColumns=True)
    return both.groupBy("feed").agg(F.count("*").alias("n"), F.countDistinct("mmsi").alias("ships"))
