"""Queries of partitions, incremental runs, sinks and downstream analytics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.functions import spatial, times
from seamark.operators import catalogue, decode, ordering, partitions
from seamark.plans import base
from seamark.plans.base import EV, KIND_SQL, Tables, c, query, scratch, sightings
from seamark.plans.decode_queries import HILBERT_SQL, PLACE_SQL
from seamark.sources import lines


def by_day(rows: DataFrame) -> DataFrame:
    return rows.select("*", *times.partition_columns(c("ts_ms"), "day"))


DAY_SQL = "strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day"


@query(f"select {DAY_SQL}, count(*) as n from events group by all")
def partition_counts(t: Tables) -> DataFrame:
    return by_day(sightings(t)).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("select event_id from events where year(ts) = 2024 and month(ts) = 1 and day(ts) = 7")
def prune_fixed(t: Tables) -> DataFrame:
    only = partitions.PartitionFilter(year=2024, month=1, day=7)
    return by_day(sightings(t)).where(only.condition("day")).select("event_id")


@query("select event_id from events where event_type = 'view' and year(ts) = 2024")
def prune_source(t: Tables) -> DataFrame:
    rows = by_day(sightings(t)).withColumn("source", c("event_type"))
    return rows.where(partitions.PartitionFilter(year=2024, source="view").condition("day")).select("event_id")


#: 2024-01-15 12:00.
SINCE_MS = 1705320000000


@query("select event_id from events where date_trunc('day', ts) + interval 1 day > timestamp '2024-01-15 12:00:00'")
def since_filter(t: Tables) -> DataFrame:
    return by_day(sightings(t)).where(partitions.PartitionFilter(since_ms=SINCE_MS).condition("day")).select("event_id")


def files(t: Tables) -> DataFrame:
    """Orders as files: a day is a partition, the price is the time of the last change, unknown for some."""
    day = times.millis("o_orderdate")
    mtime = F.when(c("o_orderkey") % 97 != 0, F.floor("o_totalprice").cast("long"))
    return t.orders.select("o_orderkey", *times.partition_columns(day, "day"), mtime.alias("mtime_ms"))


FILES_SQL = "files as (select o_orderkey, strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month, strftime(o_orderdate, '%d') as day, case when o_orderkey % 97 <> 0 then cast(floor(o_totalprice) as bigint) end as mtime_ms from orders)"


@query(f"with {FILES_SQL} select year, month, day, max(mtime_ms) as newest, count(*) as files from files group by all having max(mtime_ms) > 400000 or bool_or(mtime_ms is null)")
def incremental_select(t: Tables) -> DataFrame:
    return partitions.new_partitions(files(t), ["year", "month", "day"], 400000).drop("unknown")


@query(f"with {FILES_SQL} select greatest(max(mtime_ms), 1000) as watermark_ms from files")
def watermark_advance(t: Tables) -> DataFrame:
    return partitions.watermark(files(t), 1000)


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 25)")
def manifest_antijoin(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_quantity > 25").select(c("l_orderkey").alias("o_orderkey"))
    return partitions.not_completed(t.orders.select("o_orderkey"), done, ["o_orderkey"])


@query("select event_id, event_type as source, cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day, case when event_id % 2 = 0 then cast(hour(ts) as int) end as hour, cast(null as int) as minute from events")
def parse_paths(t: Tables) -> DataFrame:
    rows = sightings(t).select("event_id", "event_type", *times.partition_columns(c("ts_ms"), "hour"))
    deep = F.when(c("event_id") % 2 == 0, F.concat(F.lit("/hour="), "hour")).otherwise("")
    path = F.concat(F.lit("/bronze/source="), "event_type", F.lit("/year="), "year", F.lit("/month="), "month", F.lit("/day="), "day", deep, F.lit("/part-0.parquet"))
    return partitions.parse_paths(rows.select("event_id", path.alias("path"))).drop("path")


@query(f"select {DAY_SQL}, count(distinct event_type) as files from events group by all")
def dry_run_plan(t: Tables) -> DataFrame:
    rows = by_day(sightings(t)).withColumn("path", F.concat_ws("/", "year", "month", "day", "event_type"))
    return partitions.dry_run(rows, ["year", "month", "day"])


@query(f"select case {KIND_SQL} when 'position' then 'positions' when 'aton' then 'atons' else {KIND_SQL} end as tab, count(*) as n from events where event_id % 10 < 8 group by all")
def route_counts(t: Tables) -> DataFrame:
    parsed = decode.parse(base.mixed_lines(t))
    names = F.create_map(*[F.lit(x) for table, kind in decode.KINDS.items() for x in (kind, table)])
    return parsed.where(c("kind").isin(*decode.KINDS.values())).groupBy(names[c("kind")].alias("tab")).agg(F.count("*").alias("n"))


@query(f"with {EV} select strftime(ts, '%Y-%m-%d') as day, count(distinct user_id % 3) as sources, count(*) as n from ev group by all")
def route_partition_groups(t: Tables) -> DataFrame:
    """Partitions by time alone, whatever the source."""
    rows = sightings(t).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (c("user_id") % 3).alias("source"))
    return rows.groupBy("day").agg(F.countDistinct("source").alias("sources"), F.count("*").alias("n"))


@query("with s as (select event_type, event_id, row_number() over (partition by event_type order by ts, event_id) as place from events) select event_type, event_id, place from s")
def sorted_batches(t: Tables) -> DataFrame:
    return places_by_type(t)


def places_by_type(t: Tables) -> DataFrame:
    """Each event's place among those of its type: numbered within days of a type, so that no task sorts a type."""
    rows = t.events.select("event_type", "event_id", "ts")
    placed = ordering.places(rows, F.concat_ws("|", "event_type", F.date_format("ts", "yyyy-MM-dd")), "ts", "event_id")
    first = placed.groupBy("event_type").agg(F.min("place").alias("first"))
    return placed.join(first, "event_type").select("event_type", "event_id", (c("place") - c("first") + 1).alias("place"))


@query("select event_type, cast((count(*) + 499) // 500 as bigint) as files from events group by event_type")
def file_row_caps(t: Tables) -> DataFrame:
    """Files of at most 500 rows, written and counted."""
    path = scratch(t, "caps")
    # rows of a file go to one task, and those of a type to many
    numbered = places_by_type(t).withColumn("file", F.floor((c("place") - 1) / 500))
    dealt = numbered.repartition("event_type", "file").sortWithinPartitions("event_type", "place")
    dealt.select("event_type", "event_id").write.options(**partitions.zstd(3, 500)).partitionBy("event_type").parquet(path)
    back = t.spark.read.parquet(path).select("event_type", c("_metadata.file_path").alias("file"))
    return back.groupBy("event_type").agg(F.countDistinct("file").alias("files"))


@query(f"with {EV} select event_id, mmsi, cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as day, sog_raw from ev where day(ts) < 10")
def sink_roundtrip(t: Tables) -> DataFrame:
    """Written in partitions, read back with pruning."""
    path = scratch(t, "sink")
    partitions.write_partitioned(sightings(t).select("ts_ms", "event_id", "mmsi", "sog_raw"), path)
    back = t.spark.read.parquet(path).where("day < 10")
    return back.select("event_id", "mmsi", c("year").cast("int"), c("month").cast("int"), c("day").cast("int"), "sog_raw")


@query("select event_type, count(*) * 2 as n from events group by event_type")
def catalog_append(t: Tables) -> DataFrame:
    """Two appends to one table of the catalogue, the second with a column more and a narrower number."""
    name = catalogue.table_name(f"events_{uuid.uuid4().hex}", "kept")
    where = scratch(t, "catalog")
    first = sightings(t).select("ts_ms", "event_type", "event_id")
    catalogue.append(first, name, location=where)
    catalogue.append(first.withColumns({"event_id": c("event_id").cast("int"), "note": F.lit("second")}), name, location=where)
    return t.spark.read.table(name).groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"with {EV}, placed as (select event_id, {PLACE_SQL} from ev), h as (select event_id, {HILBERT_SQL} as hilbert from placed) select event_id, row_number() over (order by hilbert, event_id) as place from h")
def hilbert_order(t: Tables) -> DataFrame:
    """Every report's place along the curve."""
    rows = sightings(t).select("event_id", spatial.hilbert(c("lat_raw") / 600000.0, c("lon_raw") / 600000.0).alias("hilbert"))
    return ordering.places(rows, F.shiftright("hilbert", 42), "hilbert", "event_id").select("event_id", "place")


@query(f"with {EV} select event_id, mmsi from ev where ((lat_raw / 600000.0 between 30 and 60 and lon_raw / 600000.0 between -160 and -60) or (lat_raw / 600000.0 between -45 and -10 and lon_raw / 600000.0 between -179 and -100))")
def geo_filter(t: Tables) -> DataFrame:
    rows = sightings(t).select("event_id", "mmsi", (c("lat_raw") / 600000.0).alias("latitude"), (c("lon_raw") / 600000.0).alias("longitude"), F.lit(1).alias("msg_type"))
    return lines.subscription(rows, [(30, -160, 60, -60), (-45, -179, -10, -100)], types=[1]).select("event_id", "mmsi")


@query("select event_type, count(*) as lines, cast(sum(strlen(props)) as bigint) as bytes, max(strlen(props)) as longest, count_if(strlen(props) >= 20) as oversize, min(ts) as first_ts, max(ts) as last_ts from events group by event_type")
def ingest_metrics(t: Tables) -> DataFrame:
    size = F.octet_length("props")
    return t.events.groupBy("event_type").agg(F.count("*").alias("lines"), F.sum(size).cast("long").alias("bytes"), F.max(size).cast("long").alias("longest"), F.count_if(size >= 20).alias("oversize"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(f"with {EV}, r as (select *, row_number() over (partition by mmsi order by ts_ms desc, event_id desc) as k from ev) select mmsi, event_id, ts_ms, {PLACE_SQL} from r where k = 1")
def latest_position_per_vessel(t: Tables) -> DataFrame:
    s = sightings(t)
    last = s.groupBy("mmsi").agg(F.max(F.struct("ts_ms", "event_id", "lat_raw", "lon_raw")).alias("last"))
    return last.select("mmsi", "last.event_id", "last.ts_ms", (c("last.lat_raw") / 600000.0).alias("latitude"), (c("last.lon_raw") / 600000.0).alias("longitude"))


@query(f"with {EV} select ev.mmsi, upper(c_name) as name, count(*) as reports from ev join customer on c_custkey = user_id group by all")
def vessel_static_join(t: Tables) -> DataFrame:
    counts = sightings(t).groupBy("mmsi").agg(F.count("*").alias("reports"))
    ships = t.customer.select((c("c_custkey") + 200000000).alias("mmsi"), F.upper("c_name").alias("name"))
    return counts.join(ships, "mmsi")


@query(f"with {EV} select date_trunc('hour', ts) as hour_start, cast(floor(lat_raw / 6000000.0) as bigint) as cell_lat, cast(floor(lon_raw / 6000000.0) as bigint) as cell_lon, count(*) as n, count(distinct mmsi) as ships from ev group by all")
def hourly_density(t: Tables) -> DataFrame:
    hour = times.period_start(c("ts_ms"), "hour").alias("hour_start")
    rows = sightings(t).select(hour, F.floor(c("lat_raw") / 6000000.0).alias("cell_lat"), F.floor(c("lon_raw") / 6000000.0).alias("cell_lon"), "mmsi")
    return rows.groupBy("hour_start", "cell_lat", "cell_lon").agg(F.count("*").alias("n"), F.countDistinct("mmsi").alias("ships"))
