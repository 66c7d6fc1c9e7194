"""Queries over the order of lines: carried timestamps, reassembly, dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions import sentences, times
from seamark.functions.settle import settled
from seamark.operators import dedup, encode, ordering
from seamark.plans.base import EV, Tables, c, position_fields, query, sightings
from seamark.plans.text_queries import fragment_lines


def fragments(t: Tables, missing: bool = False) -> DataFrame:
    """Fragment lines in the order of conversation and turn; with ``missing``, every fifth conversation lacks its last."""
    rows = fragment_lines(t)
    if missing:
        rows = rows.where("not (conv_id % 5 = 0 and turn + 1 = n)")
    station = F.concat(F.lit("C"), c("conv_id").cast("string"))
    tagged = F.when(c("turn") == 0, encode.tagged(c("payload"), station, c("conv_id") + 1)).otherwise(c("payload"))
    return rows.select(c("conv_id").cast("string").alias("source"), (c("conv_id") * 1000 + c("turn")).alias("line"), ((c("conv_id") + 1) * 1000).alias("ts_ms"), tagged.alias("payload"))


#: The armor of each message, and how many fragments it has.
WHOLE_SQL = "with m as (select conv_id, count(*) as n, string_agg(lpad(cast(length(text) as varchar), 8, '0'), '' order by turn) as armor from conversations group by conv_id)"


@query(f"{WHOLE_SQL} select conv_id, (conv_id + 1) * 1000 as ts_ms, armor from m where n > 1")
def reassemble(t: Tables) -> DataFrame:
    whole = ordering.reassemble(fragments(t)).where("complete")
    armor = F.get(F.split(sentences.sentence(c("payload")), ","), F.lit(5))
    told = whole.where("payload like '%AIVDM,1,1,,B%'").select((F.expr("line div 1000")).alias("conv_id"), "ts_ms", armor.alias("armor"))
    return told.join(t.conversations.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id"), "conv_id")


@query(f"{WHOLE_SQL} select conv_id, (conv_id + 1) * 1000 as ts_ms, armor from m where n > 1")
def reassemble_shuffled(t: Tables) -> DataFrame:
    """Every fragment comes twice, and those of a message in an order that has nothing to do with their numbers."""
    twice = fragments(t).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    mixed = F.expr("line div 1000 * 1000000") + F.pmod(F.xxhash64("line", "again"), F.lit(100_000)) * 10 + c("again")
    whole = ordering.reassemble(twice.select("source", mixed.alias("line"), "ts_ms", "payload")).where("complete and payload like '%AIVDM,1,1,,B%'")
    armor = F.get(F.split(sentences.sentence(c("payload")), ","), F.lit(5))
    told = whole.select(F.expr("line div 1000000").alias("conv_id"), "ts_ms", armor.alias("armor"))
    told = told.join(t.conversations.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id"), "conv_id")
    # what comes after a message is whole may make it whole again
    return told.distinct()


@query(f"{WHOLE_SQL} select conv_id, 'c:' || (conv_id + 1) || ',s:C' || conv_id as tags from m where n > 1")
def rebuild_tag(t: Tables) -> DataFrame:
    whole = ordering.reassemble(fragments(t)).where("complete and payload like '%AIVDM,1,1,,B%' and payload like '%c:%,s:%'")
    return whole.select(F.expr("line div 1000").alias("conv_id"), F.regexp_extract(sentences.tag_block(c("payload")), r"^([^*]*)", 1).alias("tags"))


@query("with m as (select *, count(*) over (partition by conv_id) as n from conversations) select conv_id, turn, lpad(cast(length(text) as varchar), 8, '0') as armor from m where n > 1 and conv_id % 5 = 0 and turn + 1 < n")
def flush_incomplete(t: Tables) -> DataFrame:
    """Fragments of messages whose last never came."""
    left = ordering.reassemble(fragments(t, missing=True)).where("not complete")
    return left.select(F.expr("line div 1000").alias("conv_id"), (c("line") % 1000).alias("turn"), F.get(F.split("payload", ","), F.lit(5)).alias("armor"))


@query("select event_type, min_by(event_id, ts) as oldest, min(ts) as first_ts from events group by event_type")
def evict_oldest(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.min_by("event_id", "ts").alias("oldest"), F.min("ts").alias("first_ts"))


def timed_lines(t: Tables) -> DataFrame:
    """By event_id modulo 6 within a user: capture line, plain sentence, first and last fragment, tagged sentence, text."""
    s = sightings(t)
    plain = encode.sentence(position_fields())
    which = c("event_id") % 6
    fragment = lambda n: sentences.closed(F.concat(F.lit(f"AIVDM,2,{n},"), (c("event_id") % 10).cast("string"), F.lit(",A,1@0000,0")), "!")
    captured = F.concat_ws(",", F.lit("$PGHP,1,2013,1,9,4,37"), (c("event_id") % 60).cast("string"), F.lit("298,,110,,1,26*19"))
    line = F.when(which == 0, captured).when(which == 1, plain).when(which == 2, fragment(1)).when(which == 3, fragment(2)).when(which == 4, encode.tagged(plain, None, c("event_id") + 1)).otherwise("text")
    return settled(s, payload=line).select(c("user_id").cast("string").alias("source"), c("event_id").alias("line"), c("ts_ms").alias("arrival_ms"), "payload")


@query(f"""with {EV}, acts as (
  select *, event_id % 6 as k, 1357706220000 + (event_id % 60) * 1000 + 298 as captured from ev),
after as (select *, case k when 2 then null else struct_pack(v := case when k = 0 then captured end) end as state from acts),
pend as (select *, last_value(state ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding).v as pending from after)
select event_id, case when k = 0 then captured when k = 4 then (event_id + 1) * 1000 when k in (1, 2, 3) then coalesce(pending, ts_ms) else ts_ms end as resolved_ms from pend""")
def ts_carry_forward(t: Tables) -> DataFrame:
    return ordering.resolve_timestamps(timed_lines(t)).select(c("line").alias("event_id"), c("ts_ms").alias("resolved_ms"))


def repeated(t: Tables) -> DataFrame:
    """Reports with their times cut to the hour, so that some repeat."""
    s = sightings(t)
    hour = F.expr("ts_ms div 3600000 * 3600000")
    return s.select(hour.alias("ts_ms"), "mmsi", F.lit(1).alias("msg_type"), (c("event_id") % 2).cast("int").alias("fid"), F.lit(1).alias("dac"), "event_id")


def dedup_sql(extra: str) -> str:
    return f"with {EV}, r as (select event_id, mmsi, ts_ms // 3600000 * 3600000 as ts_ms, row_number() over (partition by ts_ms // 3600000, mmsi{extra} order by event_id) as k from ev) select event_id, ts_ms, mmsi from r where k = 1"


@query(dedup_sql(""))
def dedup_positions(t: Tables) -> DataFrame:
    return dedup.dedup(repeated(t), "positions", ("event_id",)).select("event_id", "ts_ms", "mmsi")


@query(dedup_sql(""))
def dedup_statics(t: Tables) -> DataFrame:
    return dedup.dedup(repeated(t), "statics", ("event_id",)).select("event_id", "ts_ms", "mmsi")


@query(dedup_sql(", event_id % 2"))
def dedup_meteo(t: Tables) -> DataFrame:
    return dedup.dedup(repeated(t), "meteo", ("event_id",)).select("event_id", "ts_ms", "mmsi")


@query("""with k as (select event_type, row_number() over (partition by event_type order by event_id) as seq, event_id, value > 400 as pending from events)
select event_type, max(event_id) as committed, count(*) as durable from k
where seq < coalesce((select min(seq) from k o where o.event_type = k.event_type and o.pending), 9223372036854775807) group by event_type""")
def frontier(t: Tables) -> DataFrame:
    """Per stream, what may be committed: all batches before the first that isn't durable."""
    gap = t.events.where("value > 400").groupBy("event_type").agg(F.min("event_id").alias("gap"))
    seen = t.events.select("event_type", "event_id").join(gap, "event_type", "left").where("gap is null or event_id < gap")
    return seen.groupBy("event_type").agg(F.max("event_id").alias("committed"), F.count("*").alias("durable"))


@query("select event_type, date_trunc('hour', ts) as hour_start, count(*) as n, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents from events group by all")
def tumbling_counts(t: Tables) -> DataFrame:
    hour = times.period_start(times.millis("ts"), "hour")
    cents = F.round(c("value") * 100).cast("long")
    return t.events.groupBy("event_type", hour.alias("hour_start")).agg(F.count("*").alias("n"), F.sum(cents).alias("cents"))
