"""JSON feed messages to the same tables as sentences.

The envelope is {"MessageType", "MetaData", "Message": {type: {...}}}; a message whose type isn't a key of
"Message" is read from "Message" itself. Values out of a field's range, or a missing required field, make the row
``failed``; unknown types become ``other``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions import bits, labels, spatial
from seamark.functions.settle import settled
from seamark.operators.decode import UNDER_WAY, carried, eta_ms

# Message type and the kind of row that it gives.
MESSAGES = {
    "PositionReport": "position",
    "StandardClassBPositionReport": "position",
    "ExtendedClassBPositionReport": "position",
    "StandardSearchAndRescueAircraftReport": "position",
    "BaseStationReport": "position",
    "ShipStaticData": "static",
    "StaticDataReport": "static",
    "AidsToNavigationReport": "aton",
}
DIMENSION = "Dimension STRUCT<A: BIGINT, B: BIGINT, C: BIGINT, D: BIGINT>"
BODY = f"""MessageID BIGINT, UserID BIGINT, Latitude DOUBLE, Longitude DOUBLE, Altitude DOUBLE, Sog DOUBLE, Cog DOUBLE, TrueHeading BIGINT,
RateOfTurn BIGINT, NavigationalStatus BIGINT, PositionAccuracy BOOLEAN, Raim BOOLEAN, SpecialManoeuvreIndicator BIGINT,
ImoNumber BIGINT, CallSign STRING, Name STRING, NameExtension STRING, Type BIGINT, {DIMENSION}, MaximumStaticDraught DOUBLE, Destination STRING,
Eta STRUCT<Month: BIGINT, Day: BIGINT, Hour: BIGINT, Minute: BIGINT>, PartNumber BOOLEAN, OffPosition BOOLEAN, VirtualAtoN BOOLEAN, AssignedMode BOOLEAN,
ReportA STRUCT<Name: STRING>, ReportB STRUCT<CallSign: STRING, ShipType: BIGINT, {DIMENSION}>"""
META = "MMSI BIGINT, ShipName STRING, latitude DOUBLE, longitude DOUBLE, time_utc STRING"
# Fields with the range of their type.
RANGES = {"MessageID": (0, 255), "UserID": (0, 2**32 - 1), "TrueHeading": (0, 65535), "RateOfTurn": (-128, 127), "NavigationalStatus": (0, 255), "SpecialManoeuvreIndicator": (0, 255), "ImoNumber": (0, 2**32 - 1), "Type": (0, 255)}
REQUIRED = {"StaticDataReport": ("MessageID", "UserID", "PartNumber"), "ShipStaticData": ("MessageID", "UserID")}
REQUIRED_ELSE = ("MessageID", "UserID", "PositionAccuracy", "Raim")


def parse(lines: DataFrame) -> DataFrame:
    """Adds msg (the message type), body (its fields) and kind to rows with a payload."""
    json = F.col("payload")
    envelope = F.from_json(json, "MessageType STRING, MetaData STRING, Message STRING")
    typed = settled(settled(lines, envelope=envelope), msg=F.col("envelope.MessageType"), meta=F.col("envelope.MetaData"), message=F.col("envelope.Message")).drop("envelope")
    own = F.lit(None).cast("string")
    for name in MESSAGES:
        own = F.when(F.col("msg") == name, F.get_json_object("message", f"$.{name}")).otherwise(own)
    read = settled(typed, body=F.from_json(F.coalesce(own, F.col("message")), BODY, {"mode": "PERMISSIVE"}))
    return settled(read, kind=kind()).drop("meta", "message")


def kind() -> Column:
    body = F.col("body")
    known = F.lit(None).cast("string")
    for name, what in MESSAGES.items():
        needs = REQUIRED.get(name, REQUIRED_ELSE)
        full = F.lit(True)
        for field in needs:
            full = full & body[field].isNotNull()
        known = F.when(F.col("msg") == name, F.when(full, what).otherwise("failed")).otherwise(known)
    fits = F.lit(True)
    for field, (low, high) in RANGES.items():
        fits = fits & F.coalesce(body[field].between(low, high), F.lit(True))
    broken = F.col("msg").isNull() | F.col("message").isNull() | F.col("meta").isNull()
    return F.when(broken, "failed").when(known.isNull(), "other").when(fits, known).otherwise("failed")


def keys(parsed: DataFrame) -> list[Column | str]:
    return carried(parsed) + [F.col("body.MessageID").cast("int").alias("msg_type"), F.col("body.UserID").alias("mmsi")]


def positions(parsed: DataFrame) -> DataFrame:
    b, msg = F.col("body"), F.col("msg")
    sar, base, class_a = msg == "StandardSearchAndRescueAircraftReport", msg == "BaseStationReport", msg == "PositionReport"
    moving = lambda c: F.when(~base, c)
    told = parsed.where("kind = 'position'").select(
        *keys(parsed),
        F.when(base, "Base Station").when(class_a | sar, "Class A").otherwise("Class B").alias("ais_class"),
        b["Latitude"].alias("latitude"), b["Longitude"].alias("longitude"), moving(b["Sog"]).alias("sog_knots"), moving(b["Cog"]).alias("cog"),
        F.when(~sar & ~base, bits.null_if(b["TrueHeading"], 511).cast("double")).alias("heading_true"),
        F.when(class_a, bits.null_if(b["RateOfTurn"], -128).cast("double")).alias("rot"), F.when(sar, b["Altitude"]).alias("altitude_m"),
        F.when(base, "").when(sar, UNDER_WAY).when(class_a, labels.nav_status(F.coalesce(b["NavigationalStatus"], F.lit(15)))).otherwise(labels.NAV_STATUS[15]).alias("nav_status"),
        b["PositionAccuracy"].alias("high_accuracy"), b["Raim"].alias("raim"),
        F.when(class_a & b["SpecialManoeuvreIndicator"].isin(1, 2), b["SpecialManoeuvreIndicator"] == 2).alias("special_manoeuvre"),
        F.lit(None).cast("string").alias("station"), "payload",
    )
    return told.withColumn("hilbert", spatial.hilbert(F.col("latitude"), F.col("longitude")))


def statics(parsed: DataFrame, eta_year: int) -> DataFrame:
    b = F.col("body")
    ship = F.col("msg") == "ShipStaticData"
    part_b = ~ship & b["PartNumber"]
    sizes = F.when(ship, b["Dimension"]).when(part_b, b["ReportB"]["Dimension"])
    eta = b["Eta"]
    return parsed.where("kind = 'static'").select(
        *keys(parsed), F.when(ship, "Class A").otherwise("Class B").alias("ais_class"), F.when(ship, bits.null_if(b["ImoNumber"], 0)).alias("imo_number"),
        bits.trimmed(F.when(ship, b["CallSign"]).when(part_b, b["ReportB"]["CallSign"])).alias("call_sign"),
        bits.trimmed(F.when(ship, b["Name"]).when(~part_b, b["ReportA"]["Name"])).alias("name"),
        F.when(ship, labels.ship_type(F.coalesce(b["Type"], F.lit(0)))).when(part_b & b["ReportB"]["ShipType"].isNotNull(), labels.ship_type(b["ReportB"]["ShipType"])).otherwise("").alias("ship_type"),
        *[sizes[k].cast("int").alias(f"dimension_to_{n}") for k, n in (("A", "bow"), ("B", "stern"), ("C", "port"), ("D", "starboard"))],
        F.when(ship, b["MaximumStaticDraught"]).alias("draught_m"), bits.trimmed(F.when(ship, b["Destination"])).alias("destination"),
        F.when(ship, eta_ms(eta["Month"], eta["Day"], eta["Hour"], eta["Minute"], F.lit(eta_year))).alias("eta_ms"),
        F.lit(None).cast("long").alias("mothership_mmsi"), F.lit(None).cast("string").alias("station"), "payload",
    )


def atons(parsed: DataFrame) -> DataFrame:
    b = F.col("body")
    told = parsed.where("kind = 'aton'").select(
        *keys(parsed), F.lit("AtoN").alias("ais_class"), labels.navaid_type(F.coalesce(b["Type"], F.lit(0))).alias("aid_type"),
        bits.trimmed(b["Name"]).alias("name"), bits.trimmed(b["NameExtension"]).alias("name_extension"), b["Latitude"].alias("latitude"), b["Longitude"].alias("longitude"),
        *[b["Dimension"][k].cast("int").alias(f"dimension_to_{n}") for k, n in (("A", "bow"), ("B", "stern"), ("C", "port"), ("D", "starboard"))],
        b["OffPosition"].alias("off_position"), b["VirtualAtoN"].alias("virtual_aid"), b["AssignedMode"].alias("assigned_mode"),
        b["PositionAccuracy"].alias("high_accuracy"), b["Raim"].alias("raim"), F.lit(None).cast("string").alias("station"), "payload",
    )
    return told.withColumn("hilbert", spatial.hilbert(F.col("latitude"), F.col("longitude")))


def other(parsed: DataFrame) -> DataFrame:
    return parsed.where("kind = 'other'").select(*carried(parsed), F.lit(None).cast("string").alias("station"), F.col("msg").alias("msg_type"), "payload")


def route(parsed: DataFrame, eta_year: int) -> dict[str, DataFrame]:
    return {"positions": positions(parsed), "statics": statics(parsed, eta_year), "atons": atons(parsed), "other": other(parsed)}
