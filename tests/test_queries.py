"""Every registered query of the AIS engine against its SQL in DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

from seamark.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value.isoformat() if hasattr(value, "isoformat") else value


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    frame = catalogue.queries()[name](spark, sf_dir)
    names = sorted(frame.columns)
    want = db.sql(f"select {', '.join(names)} from ({catalogue.oracle_sql()[name]})").fetchall()
    got = frame.select(*names).collect()
    key = lambda rows: sorted(str([plain(v) for v in r]) for r in rows)
    assert key(got) == key(want)


#: Tested against the grid's own properties and published cells in test_spatial.
WITHOUT_SQL = {"h3_cell"}


def test_all_queries_have_sql():
    assert set(catalogue.queries()) - WITHOUT_SQL == set(catalogue.oracle_sql())
