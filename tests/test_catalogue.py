"""Tables of the catalogue: made, added to in their own types, and grown."""

import uuid

import pytest
from pyspark.sql import functions as F

from seamark.jobs import config, decode, ingest
from seamark.operators import catalogue
from tests.test_jobs import DAY_1, POSITION, put


def test_names():
    assert catalogue.table_name("positions") == "`positions`"
    assert catalogue.table_name("positions", "", "sea.ais") == "`sea`.`ais`.`positions`"
    assert catalogue.table_name("atons", "live", "a`b") == "`a``b`.`live_atons`"


def test_rows_in_the_tables_types_and_new_columns(spark, tmp_path):
    name = catalogue.table_name("t", "x" + uuid.uuid4().hex[:8])
    first = spark.createDataFrame([(86_400_000, 1, 2**40, "a")], "ts_ms long, k int, n long, gone string")
    catalogue.append(first, name, location=f"file://{tmp_path}/t")
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["year=1970/month=01/day=02"]
    second = spark.createDataFrame([(0, 5, 7, 2.5)], "ts_ms long, n int, K long, more double")
    catalogue.append(second, name, location=f"file://{tmp_path}/t")
    got = {(r.k, r.n, r.gone, r.more) for r in spark.table(name).collect()}
    assert got == {(1, 2**40, "a", None), (7, 5, None, 2.5)}
    assert dict(spark.table(name).dtypes)["n"] == "bigint"
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        catalogue.append(second.withColumn("K", F.lit(2**50)), name)
    assert spark.table(name).count() == 2


def test_minutes_are_hours(spark, tmp_path):
    name = catalogue.table_name("m" + uuid.uuid4().hex[:8])
    catalogue.append(spark.createDataFrame([(90 * 60_000, 1)], "ts_ms long, k int"), name, "minute", location=f"file://{tmp_path}/m")
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["year=1970/month=01/day=01/hour=01"]


def test_a_job_writes_to_the_catalogue(spark, tmp_path):
    raw, bronze, out = (f"file://{tmp_path}/{n}" for n in ("raw", "bronze", "out"))
    put(tmp_path / "raw", "a.txt", [POSITION, "junk"], DAY_1)
    ingest.run(spark, config.IngestConfig((raw,), bronze))
    space = "sea" + uuid.uuid4().hex[:6]
    decode.run(spark, config.DecodeConfig((bronze,), out, namespace=space, table_prefix="live"))
    [row] = spark.table(f"{space}.live_positions").collect()
    assert row.h3 and row.year == "2023" and not spark.catalog.tableExists(f"{space}.live_statics")
