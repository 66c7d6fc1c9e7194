"""Names of AIS codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NAV_STATUS = (
    "under way using engine", "at anchor", "not under command", "restricted manoeuverability", "constrained by draught", "moored",
    "aground", "engaged in fishing", "under way sailing", "(reserved9)", "(reserved10)", "(reserved11)", "(reserved12)", "(reserved13)",
    "ais sart is active", "(notDefined)",
)
# First code, name; each holds up to the next.
SHIP_TYPE = (
    (0, "(not available)"), (20, "wing in ground"), (30, "fishing"), (40, "high-speed craft"), (50, "pilot"), (51, "search and rescue"),
    (52, "tug"), (53, "port tender"), (54, "anti-pollution equipment"), (55, "law enforcement"), (56, "(local)"), (58, "medical transport"),
    (59, "noncombatant"), (60, "passenger"), (70, "cargo"), (80, "tanker"), (90, "other"), (100, "(not available)"),
)
# Fixed values.
NAVAID_TYPE = (
    "not specified", "reference point", "RACON", "FixedStructure", "(reserved)", "light without sectors", "light with sectors",
    "leading light front", "leading light rear", "cardinal beacon, north", "cardinal beacon, east", "cardinal beacon, south",
    "cardinal beacon, west", "lateral beacon, port side", "lateral beacon, starboard side",
    "lateral beacon, preferred channel, port side", "lateral beacon, preferred channel, starboard side", "isolated danger beacon",
    "safe water", "special mark", "cardinal mark, north", "cardinal mark, east", "cardinal mark, south", "cardinal mark, west",
    "port hand mark", "starboard hand mark", "preferred channel, port side", "preferred channel, starboard side", "isolated danger",
    "safe water", "special mark", "light vessel",
)


def listed(code: Column, names: tuple[str, ...], other: str) -> Column:
    """The name at a code's place, from 0."""
    return F.coalesce(F.get(F.array(*map(F.lit, names)), code.cast("int")), F.lit(other))


def nav_status(code: Column) -> Column:
    return listed(code, NAV_STATUS, NAV_STATUS[15])


def navaid_type(code: Column) -> Column:
    return listed(code, NAVAID_TYPE, NAVAID_TYPE[0])


def ship_type(code: Column) -> Column:
    named = F.lit(SHIP_TYPE[0][1])
    for first, name in SHIP_TYPE[1:]:
        named = F.when(code >= first, name).otherwise(named)
    return named
