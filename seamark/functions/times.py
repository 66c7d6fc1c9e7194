"""Calendar partitions of UTC times held as milliseconds since 1970, free of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("year", "month", "day", "hour", "minute")
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def millis(ts: str) -> Column:
    """Milliseconds of a column without time zone."""
    return F.expr(f"cast(timestampdiff(MILLISECOND, {EPOCH}, {ts}) as bigint)")


def moment(ms: Column) -> Column:
    """A time without time zone; those before 1970 count as 1970."""
    late = F.greatest(ms, F.lit(0)).cast("long")
    return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (late / 1000).cast("decimal(18,6)"))


def period_start(ms: Column, grain: str) -> Column:
    return F.date_trunc(grain, moment(ms)).cast("timestamp_ntz")


def period_end(ms: Column, grain: str) -> Column:
    step = {"year": "INTERVAL '1' YEAR", "month": "INTERVAL '1' MONTH", "day": "INTERVAL '1' DAY", "hour": "INTERVAL '1' HOUR", "minute": "INTERVAL '1' MINUTE"}[grain]
    return period_start(ms, grain) + F.expr(step)


def partition_columns(ms: Column, grain: str = "day") -> list[Column]:
    """year, month, day, hour and minute as far as the grain goes, zero-padded for use in paths."""
    at = moment(ms)
    parts = {"year": F.lpad(F.year(at).cast("string"), 4, "0"), "month": F.month(at), "day": F.day(at), "hour": F.hour(at), "minute": F.minute(at)}
    return [(parts[g] if g == "year" else F.lpad(parts[g].cast("string"), 2, "0")).alias(g) for g in GRAINS[: GRAINS.index(grain) + 1]]
