"""Embeddings and URLs against brute force, and the pipeline end to end."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seamark.llm import embeddings, mixing, quality, registry, storage, urls
from tests.llm.test_documents import roots


def clustered(seed=0, groups=40, dims=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(rng.integers(1, 9)):
            rows.append(centre + rng.normal(size=dims) * rng.choice([0.0, 0.1, 0.25, 0.6]))
    return rows


def test_near_vectors(spark):
    rows = clustered()
    table = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (None, table[0][1]), (1004, [1.0, 0.0]), (1005, [2.0, 0.0]), (1006, [])]
    df = spark.createDataFrame([(*r, 1, 2) for r in table + odd], "vec_id long, embedding array<float>, label int, n int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    units = np.array([np.array(v) / np.linalg.norm(v) for _, v in table])
    mask = units @ units.T >= 0.9
    np.fill_diagonal(mask, False)
    want = roots(range(len(table)), [(int(a), int(b)) for a, b in zip(*np.nonzero(mask), strict=True)])
    assert mask.sum() > 50
    assert {i: got[i] for i in want} == {i: (int(mask[i].sum()), want[i]) for i in want}
    assert got[1004] == (1, 1004) and got[1005] == (1, 1004) and got[None] == (0, None)
    assert all(got[i] == (0, i) for i in (1000, 1001, 1002, 1003, 1006))


def settle(points, nodes):
    leaf, radii = np.empty(len(points), int), np.full(len(nodes), -1.0)
    for rows, numbers, distances in embeddings.descend(nodes[0], points):
        leaf[rows] = numbers
        radii[numbers[0]] = distances.max()
    return leaf, radii


def below(nodes, k):
    return embeddings.leaves_below(nodes, {k})


@pytest.mark.parametrize("spread", [0.02, 0.15, 3.0])
def test_tree_bounds_drop_no_pair(spread):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    points = np.concatenate([c + spread * rng.normal(size=(80, 8)) for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    reach = float(np.sqrt(0.2))
    nodes = embeddings.lay_out(points[::2], reach / 2)
    assert nodes[0].children
    leaf, radii = settle(points, nodes)
    compared, linked = embeddings.traverse(nodes, radii, reach)
    pairs = {(min(a, b), max(a, b)) for a, b in compared.tolist()}
    sure = [(x, y) for a, b in linked.tolist() for x in below(nodes, a) for y in below(nodes, b)]
    sure = {(min(a, b), max(a, b)) for a, b in sure}
    near = points @ points.T >= 0.9
    assert all(((min(leaf[a], leaf[b]), max(leaf[a], leaf[b])) in pairs) != ((min(leaf[a], leaf[b]), max(leaf[a], leaf[b])) in sure) for a, b in np.argwhere(near))
    for a, b in sure:
        assert near[np.ix_(leaf == a, leaf == b)].all()
    if spread < 1:
        assert len(pairs) < len(set(leaf)) * (len(set(leaf)) + 1) / 4
    assert spread > 0.1 or len(linked)


def test_tree_compares_few_pairs_of_clustered_vectors():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 64))[rng.integers(0, 500, 100_000)] + 0.03 * rng.normal(size=(100_000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    reach = float(np.sqrt(0.2))
    nodes = embeddings.lay_out(points[: embeddings.SAMPLE], reach / 2)
    leaf, radii = settle(points, nodes)
    compared, linked = embeddings.traverse(nodes, radii, reach)
    counts = np.bincount(leaf, minlength=len(nodes)).astype(float)
    assert (counts[compared[:, 0]] * counts[compared[:, 1]]).sum() < 0.25 * len(points) ** 2


def test_vectors_of_a_tight_cluster(spark):
    """A pair of nodes that lies in reach as a whole is counted without comparing."""
    rng = np.random.default_rng(5)
    rows = np.concatenate([rng.normal(size=(1, 16)) + 0.01 * rng.normal(size=(300, 16)), rng.normal(size=(60, 16)), np.ones((20, 16)) + 0.2 * rng.normal(size=(20, 16))])
    table = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows[rng.permutation(len(rows))])]
    table += [(1000 + i, v) for i, v in table[:30]]
    units = np.array([np.array(v) / np.linalg.norm(v) for _, v in table])
    mask = units @ units.T >= 0.9
    np.fill_diagonal(mask, False)
    ids = [i for i, _ in table]
    want = roots(ids, [(ids[a], ids[b]) for a, b in np.argwhere(mask)])
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(spark.createDataFrame(table, "vec_id long, embedding array<float>")).collect()}
    assert got == {i: (int(m.sum()), want[i]) for i, m in zip(ids, mask, strict=True)}


def test_tiles_of_vectors_without_structure_are_few():
    """Leaves of one class share bundles; pairs of small nodes don't take their leaves out of them."""
    rng = np.random.default_rng(6)
    points = rng.normal(size=(2000, 64))
    points = np.concatenate([points, points[:900] + 0.01 * rng.normal(size=(900, 64))])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    reach = float(np.sqrt(0.2))
    nodes = embeddings.lay_out(points[: embeddings.SAMPLE], reach / 2)
    leaf, radii = settle(points, nodes)
    classes = np.zeros(len(nodes), np.int64)
    for _, numbers, distances in embeddings.descend(nodes[0], points):
        classes[numbers[0]] += len(distances)
    compared, linked = embeddings.traverse(nodes, radii, reach, classes)
    assert not len(linked) and all(classes[a] > 1 for a, b in compared.tolist() if a == b)
    counts = dict(zip(*(x.tolist() for x in np.unique(leaf, return_counts=True)), strict=True))
    of, cuts, pairs = embeddings.meetings(nodes, compared, linked, counts, embeddings.SMALLEST_TILE)
    assert len(set(of.values())) <= 8 and sum(cuts[a] * cuts[b] for a, b in pairs) <= 40
    near, bundles = points @ points.T >= 0.9, np.array([of[k] for k in leaf.tolist()])
    met = set(pairs)
    assert all((min(bundles[a], bundles[b]), max(bundles[a], bundles[b])) in met for a, b in np.argwhere(near) if a != b)


def test_vectors_of_an_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


#: As the contract of the query states them.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def judge(url):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return host, path, max(fits, key=lambda r: len(r[0] + r[1]), default=None)


@pytest.mark.parametrize("most", [urls.FILTER_BYTES, 0])
def test_url_filter(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "FILTER_BYTES", most)
    names = ["https://WWW.Example.com/en/1", "http://example.com/en/7x", "http://m.a.example.net/de/80?x", "x://b.org/es/?q", "http://b.org?x/es/", None, "no scheme", "a://", "http://q.io/p/", "http://www.q.io/p", "http://m.q.io/p?x=1#y", "http://a://b", "https://xcom/en/", "http://com/en/#f", "http://a.net/fr/1", "http://b.net/de/1", "http://net/de", "http://example.net/de/81"]
    pages = spark.createDataFrame([(i, u, 5) for i, u in enumerate(names)] + [(0, names[0], 6)], "page_id long, url string, block int")
    listed = spark.createDataFrame([("q.io/p",), (None,), ("q.io/p",), ("other/x",)], "canon string")
    rows = urls.filter_urls(pages, listed).collect()
    assert len(rows) == len(names) + 1
    for r in rows:
        host, path, rule = judge(names[r.page_id])
        hit = r.page_id in (8, 9, 10)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0] + rule[1])
        assert r.verdict == (rule[2] if rule else "block" if hit else "allow") and r.listed == hit and (r.possible or not hit)
    assert urls.filter_urls(pages.limit(0), listed).collect() == []
    assert {r.listed for r in urls.filter_urls(pages, listed.limit(0)).collect()} == {False}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
        assert docs.columns == names, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert {r[0] for r in docs.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.where("start = 0").count() == docs.count()


def test_tables_of_a_step_are_deleted(spark, tmp_path):
    made = []
    with storage.cleared(spark):
        one = storage.materialize(spark.range(3), "one")
        made.append(one.inputFiles()[0])
        with storage.cleared(spark):
            made.append(storage.materialize(one, "two").inputFiles()[0])
        assert [os.path.exists(f.removeprefix("file://")) for f in made] == [True, False]
        kept = storage.written(one, f"file://{tmp_path}/kept")
    assert not any(os.path.exists(f.removeprefix("file://")) for f in made) and kept.count() == 3
    with pytest.raises(ZeroDivisionError), storage.cleared(spark):
        made.append(storage.materialize(spark.range(3), "three").inputFiles()[0])
        1 / 0
    assert not os.path.exists(made[-1].removeprefix("file://"))


def test_row_numbers_stay(spark, tmp_path):
    for n in range(3):
        spark.range(n * 10, n * 10 + 7).withColumn("__path", F.lit("x")).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/a b%")
    docs = spark.read.parquet(f"file://{tmp_path}/a b%")
    one = {(r["id"], r["n"]) for r in storage.row_numbers(docs, "n").collect()}
    two = {(r["id"], r["n"]) for r in storage.row_numbers(docs, "n").repartition(5).select("id", "n").collect()}
    assert one == two and len({n for _, n in one}) == 21
    other = storage.row_numbers(docs.select(F.explode(F.array("id", "id")).alias("id")), "n")
    assert other.select("n").distinct().count() == 42


@pytest.mark.parametrize("most", [storage.SMALL_ROWS, 0])
def test_pipeline_with_joins_of_both_kinds(spark, sf_dir, monkeypatch, most):
    monkeypatch.setattr(storage, "SMALL_ROWS", most)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf_dir).select("doc_id", "text").collect()
    found = quality.judged(docs).where("kept").select("doc_id", "removed").collect()
    texts = dict(docs.select("doc_id", "text").collect())
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in found)
    cut = {r.doc_id for r in found if r.removed}
    assert {r.doc_id for r in kept if r.text != texts[r.doc_id]} == cut
    mixed = Counter(r[0] for r in corpus_pipeline.mix_sources(spark, docs, sf_dir).select("doc_id").collect())
    assert mixed == Counter({r.doc_id: r.copies for r in mixing.mix(docs).where("copies > 0").collect()})


def test_pipeline_leaves_little_behind(spark, sf_dir):
    root = storage.shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(f"{root}/seamark"))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    left = {name.rpartition("-")[0] for name in set(os.listdir(f"{root}/seamark")) - before}
    assert left <= {"mixing", "pieces"}


def test_pipeline_on_odd_documents(spark):
    """Nulls, repeats, clashing names and a long line in every stage; and the same of no rows."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=80)) + f"\nline of {i}" for i in range(30)]
    rows = [(i, t, "en", ["a", None][i % 2], 1, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[1], None, None, None, None, None, None), (None, None, "en", "a", 0, "", "", ""), (7, "", "en", "a", 0, "", "", ""), (8, "short", "en", "a", 5, "", "", "")]
    rows.append((500, "long " * 60 + "".join(rng.choices("abcdef", k=200_000)) + " " + " ".join(words), "en", "a", 1, "x", "y", "z"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row string, __copy string, __found string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), "").collect() == [], name
        found = stage(spark, docs, "")
        assert found.columns == docs.columns, name
        got = found.collect()
        assert {r["__found"] for r in got} <= {"x", "y", "z", "", None} and {r["doc_id"] for r in got} <= {r[0] for r in rows}
        if name == "quality rules":
            assert {r["doc_id"] for r in got} == {*range(30), None, 500} and len(got) == 33
        if name == "line dedup":
            assert len(got) == len(rows) and sum((r["text"] or "").startswith(texts[0].split("\n")[0]) for r in got) == 2
            assert sum((r["text"] or "").startswith(texts[1].split("\n")[0]) for r in got) == 1
        if name == "near-duplicates":
            assert len(got) == len(rows) - 2 and sum(r["text"] == texts[0] for r in got) == 1
        if name == "mixing":
            assert max(Counter(r["text"] for r in got if r["text"] and r["text"] not in texts[:2]).values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sum(r["start"] == 0 for r in pieces) == len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").collect() == []


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, name):
    import duckdb

    from tests.test_queries import TABLES, plain

    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    frame = registry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    want = db.sql(f"select {', '.join(columns)} from ({registry.oracle_sql()[name]})").fetchall()
    key = lambda rows: sorted(str([plain(v) for v in r]) for r in rows)
    assert key(frame.select(*columns).collect()) == key(want)
