"""Cuts, forms and restored texts against plain Python, and the containers of offsets against sorted lists."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.llm import infilling as inf
from seamark.llm import queries, registry


def modelled(doc_id, text, pieces):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(pieces)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", text, None, None
    pre, mid, suf = "".join(pieces[:a]), "".join(pieces[a:b]), "".join(pieces[b:])
    if h[3] % 100 < 20:
        return n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", a, b - a
    return n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", a, b - a


TEXTS = [None, "", "a", "é", "<P", "<", "<P><S", "x<S>y", "<M", "\n", "a\n\nb c", "日本語 テキスト", "😀" * 40_000, "ab" * 70_000, "é" * 3 + "x" * 66_000 + "日" * 30_000, " lead and trail ", "P><S>"]


def odd(spark):
    rng = random.Random(3)
    more = ["".join(rng.choice("ab <PSM>é日😀\n") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    rows = [(None if i == 5 else i, t, "f", 1) for i, t in enumerate(TEXTS + more)]
    rows += rows[:3]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, form string, N int").repartition(3)


@pytest.mark.parametrize(("unit", "cut"), [("characters", list), ("words", lambda t: re.findall(r"^[ \t\n\v\f\r]+(?=.|$)|[^ \t\n\v\f\r]+[ \t\n\v\f\r]*", t, re.S)), ("lines", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t))])
def test_cuts_equal_a_model(spark, unit, cut):
    rows, docs = odd(spark)
    found = inf.fill_in_middle(docs, unit=unit)
    got = found.select("doc_id", "text", "n", "form", "output", "prefix_units", "middle_units", inf.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert tuple(r)[2:7] == modelled(r["doc_id"], r["text"] or "", cut(r["text"] or "")), r["text"]
        assert r["back"] == (r["text"] or "")


def test_containers_select_like_a_list():
    rng = np.random.default_rng(1)
    for most, number in [(10, 3), (70_000, 60_000), (200_000, 500), (200_000, 190_000), (1 << 20, 400_000), (300_000, 299_999)]:
        offsets = np.sort(rng.choice(most, number, replace=False))
        places = inf.BoundarySet(offsets)
        assert len(places) == number
        for k in {0, number - 1, *rng.integers(0, number, 200).tolist()}:
            assert places.select(k) == offsets[k]


def test_containers_are_the_smallest():
    kinds = lambda offsets: [type(c) for c in inf.BoundarySet(np.asarray(offsets)).containers]
    assert kinds(np.arange(70_000)) == [inf.RunContainer] * 2
    assert kinds(np.arange(0, 65_536, 2)) == [inf.BitmapContainer]
    assert kinds(np.arange(0, 65_536, 40)) == [inf.ArrayContainer]


def test_empty_table_and_unknown_unit(spark):
    docs = odd(spark)[1]
    assert inf.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        inf.fill_in_middle(docs, unit="tokens")


def test_query_equals_sql(spark, sf_dir):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    frame = queries.op11_fill_in_middle(spark, sf_dir)
    want = db.sql(f"select {', '.join(frame.columns)} from ({registry.oracle_sql()['op11_fill_in_middle']})").fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(want)
