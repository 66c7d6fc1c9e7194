"""Embedding near-duplicates: all pairs over a cosine threshold, by a dual traversal of a cover tree.

Vectors with equal components are one class. The tree's levels are nested nets of a bounded sample of
classes: a node's first child has its centre, children are more than half the node's radius apart, and
radii halve from level to level down to the distance that the threshold allows. Every class then descends
to a leaf, and each node's covering radius is the largest distance of all classes below it, so bounds hold
for the whole table. The traversal starts with the pair (root, root). It drops a pair of nodes where the
distance of their centres exceeds the sum of their covering radii and the allowed distance, counts all
pairs at once where that sum stays under it, and splits the others. Pairs of leaves that remain are
compared exactly, as matrix products in double precision, in tiles of bounded size that hold a large
leaf's part or several leaves. On vectors without structure no bound holds and all tiles are compared.

A tile returns each class's number of linked vectors and one edge to the smallest class of its own local
component, never a list of pairs. Nulls, zero vectors and vectors with null or non-finite components link
with nothing; so do rows with a null vec_id. Vectors of different lengths don't link. Rows with equal
vec_ids are one node. Repeated rows are returned each. Empty input gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.components import components
from seamark.llm.storage import materialize

SAMPLE, SAMPLE_BYTES = 1024, 16 << 20
#: Far over the rounding of distances of unit vectors; closer bounds decide nothing.
SLACK = 1e-6
LARGEST_TILE, SMALLEST_TILE, LEAST_GROUPS = 8192, 512, 12
#: Pairs of nodes with fewer pairs of classes are compared in a tile, since counting them at once would keep their leaves out of tiles with others.
WORTH = 1 << 16


@dataclass
class Node:
    number: int
    centre: np.ndarray
    children: list[Node] = field(default_factory=list)


def lay_out(points: np.ndarray, least_radius: float) -> list[Node]:
    """A cover tree over unit vectors, root first: nets with radii that halve from 2 on; a node is its children's first centre."""
    nodes: list[Node] = []

    def grow(inside: np.ndarray, centre: np.ndarray, radius: float) -> Node:
        node = Node(len(nodes), centre)
        nodes.append(node)
        near = np.linalg.norm(inside - centre, axis=1)
        while radius >= least_radius and near.max() <= radius / 2:
            radius /= 2  # a level at which the node is its only child
        if radius / 2 < least_radius:
            return node
        centres, owner = [centre], np.zeros(len(inside), np.int64)
        while near[far := int(near.argmax())] > radius / 2:
            away = np.linalg.norm(inside - inside[far], axis=1)
            owner[away < near] = len(centres)
            centres.append(inside[far])
            near = np.minimum(near, away)
        node.children = [grow(inside[owner == k], c, radius / 2) for k, c in enumerate(centres)]
        return node

    grow(points, points[0], 2.0)
    return nodes


def descend(root: Node, points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, node numbers, distances) for every node on the rows' ways down; leaves come last for each row."""
    steps, todo = [], [(root, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        steps.append((rows, np.full(len(rows), node.number), np.linalg.norm(points[rows] - node.centre, axis=1)))
        if node.children:
            nearest = (points[rows] @ np.stack([c.centre for c in node.children]).T).argmax(axis=1)
            todo += [(c, rows[nearest == k]) for k, c in enumerate(node.children)]
    return steps


def traverse(nodes: list[Node], radii: np.ndarray, reach: float, classes: np.ndarray | None = None, at_once: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of leaves to compare, and pairs of nodes whose points are all within ``reach``; a node without points has a radius of -1.

    With the number of classes below each node, only pairs of nodes with ``WORTH`` pairs of them are of the second kind, and
    a node of one class doesn't meet itself.
    """
    centres = np.stack([n.centre for n in nodes])
    inner = np.array([bool(n.children) for n in nodes])
    below = [np.array([c.number for c in n.children if radii[c.number] >= 0], np.int64) for n in nodes]
    compare, linked = [np.empty((0, 2), np.int64)], [np.empty((0, 2), np.int64)]
    todo = [np.zeros((1, 2), np.int64)] if radii[0] >= 0 else []
    while todo:
        pairs = todo.pop()
        a, b = pairs.T
        apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", centres[a], centres[b])))
        cover = radii[a] + radii[b]
        sure = apart + cover < reach - SLACK
        single = np.zeros(len(a), bool)
        if classes is not None:
            sure &= classes[a] * classes[b] >= WORTH
            single = (a == b) & (classes[a] == 1)
        linked.append(pairs[sure])
        open_ = ~sure & ~single & ((a == b) | (apart - cover <= reach + SLACK))
        ends = ~inner[a] & ~inner[b]
        compare.append(pairs[open_ & ends])
        split: list[np.ndarray] = []
        for x, y in pairs[open_ & ~ends].tolist():
            if x == y:
                i, j = np.triu_indices(len(below[x]))
                split.append(np.stack([below[x][i], below[x][j]], axis=1))
            else:
                if not inner[x] or (inner[y] and radii[y] > radii[x]):
                    x, y = y, x
                split.append(np.stack([below[x], np.full(len(below[x]), y)], axis=1))
        if split:
            found = np.concatenate(split)
            todo += [found[at : at + at_once] for at in range(0, len(found), at_once)]
    return np.concatenate(compare), np.concatenate(linked)


def bundle(leaves: list[int], counts: dict[int, int], alone: set[int], size: int) -> tuple[dict[int, int], list[int]]:
    """The bundle of each leaf, and the number of parts of each bundle: small leaves in a row share one, large ones are cut."""
    of, held, last = {}, [], None
    for leaf in leaves:
        if leaf in alone or counts[leaf] > size or last is None or held[last] + counts[leaf] > size:
            held.append(0)
            last = len(held) - 1
        of[leaf] = last
        held[last] += counts[leaf]
        if leaf in alone or counts[leaf] > size:
            last = None
    return of, [-(-n // size) for n in held]


def unit_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, a key of the vector's components, and the unit vector as doubles; key and unit are null where it cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = [], []
            column = batch.column("embedding")
            ends = column.offsets.to_numpy().tolist()
            values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls are NaN
            for begin, end, there in zip(ends[:-1], ends[1:], column.is_valid().to_pylist(), strict=True):
                v = values[begin:end] if there else values[:0]
                norm = float(np.sqrt((v * v).sum()))
                if norm > 0 and np.isfinite(norm):
                    keys.append(hashlib.md5(v.tobytes(), usedforsecurity=False).digest())
                    units.append((v / norm).tobytes())
                else:
                    keys.append(None)
                    units.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], names=["vec_id", "key", "unit"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, key binary, unit binary")


def tile_links(first: pd.DataFrame, second: pd.DataFrame | None, least: float) -> pd.DataFrame:
    """Numbers of links and local component roots of the classes of a tile; ``second`` is None for a group against itself."""
    frames = [first] if second is None else [first, second]
    ids, weights = np.concatenate([f["id"] for f in frames]), np.concatenate([f["n"] for f in frames]).astype(np.float64)
    a = np.frombuffer(b"".join(first["unit"]), np.float64).reshape(len(first), -1)
    b, base = (a, 0) if second is None else (np.frombuffer(b"".join(second["unit"]), np.float64).reshape(len(second), -1), len(first))
    order = np.argsort(ids, kind="stable")
    label = np.empty(len(ids), np.int64)
    label[order] = np.arange(len(ids))  # of equal size as ids: the smallest id has the smallest label
    links = np.zeros(len(ids))
    step = max(1, (1 << 22) // max(1, len(b)))
    for at in range(0, len(a), step):
        mask = a[at : at + step] @ b.T >= least
        if second is None:
            mask[np.arange(len(mask)), np.arange(at, at + len(mask))] = False
        i, j = np.nonzero(mask)
        if not len(i):
            continue
        links[at : at + len(mask)] += mask @ weights[base : base + len(b)]
        if second is not None:
            links[base:] += weights[at : at + len(mask)] @ mask
        i, j = i + at, j + base
        while True:
            low = np.minimum(label[i], label[j])
            if (label[i] == low).all() and (label[j] == low).all():
                break
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = np.minimum(label, label[order[label]])  # a label's holder may know a smaller one
    some = links > 0
    return pd.DataFrame({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[order[label[some]]]})


def leaves_below(nodes: list[Node], some: set[int]) -> set[int]:
    found, todo = set(), [nodes[k] for k in some]
    while todo:
        node = todo.pop()
        todo += node.children
        if not node.children:
            found.add(node.number)
    return found


def meetings(nodes: list[Node], compared: np.ndarray, linked: np.ndarray, counts: dict[int, int], size: int) -> tuple[dict[int, int], list[int], list[tuple[int, int]]]:
    """The bundle of each leaf, the number of parts of each bundle, and the pairs of bundles that meet."""
    # a leaf below a node that is in a counted pair must not share a tile with others, which could count that pair again
    alone = {k for k in counts if k < 0} | leaves_below(nodes, set(linked.ravel().tolist()))
    of, cuts = bundle(sorted(counts), counts, alone, size)
    return of, cuts, sorted({(min(of[a], of[b]), max(of[a], of[b])) for a, b in compared.tolist()} | {(of[k], of[k]) for k in counts if k < 0})


def roots_of(linked: np.ndarray, least_id: np.ndarray) -> dict[int, int]:
    """For each node in a counted pair, the smallest id below all nodes that such pairs connect it with."""
    root = {k: int(least_id[k]) for k in linked.ravel().tolist()}
    changed = True
    while changed:
        changed = False
        for a, b in linked.tolist():
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def near_vectors(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """Per row: vec_id, n_links and component_id."""
    rows = materialize(unit_rows(vectors), "units")
    linkable = rows.where("vec_id is not null and key is not null")
    classes = materialize(linkable.groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "vector-classes")
    leads = linkable.join(classes, "key").where("vec_id = id").dropDuplicates(["key"])
    leads = materialize(leads.select("id", "n", "unit", F.octet_length("unit").alias("bytes")), "vector-leads")
    total = leads.count()

    place = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30))
    sampled = leads.where(place <= int(SAMPLE / max(total, 1) * (1 << 30))).orderBy(place, "id").limit(SAMPLE).select("bytes", "unit").collect()
    kinds = [r["bytes"] for r in sampled]
    common = max(set(kinds), key=lambda k: (kinds.count(k), k), default=0)
    points = np.array([np.frombuffer(r["unit"], np.float64) for r in sampled if r["bytes"] == common][: max(1, SAMPLE_BYTES // max(common, 1))])
    reach = float(np.sqrt(2 - 2 * least))
    nodes = lay_out(points, reach / 2) if len(points) else [Node(0, np.zeros(0))]

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("bytes").to_numpy()
            leaf, path, away = -sizes.astype(np.int64), [[] for _ in sizes], [[] for _ in sizes]
            at = np.flatnonzero(sizes == common)
            if len(at):
                units = batch.column("unit").take(pa.array(at)).to_pylist()
                for which, numbers, distances in descend(nodes[0], np.frombuffer(b"".join(units), np.float64).reshape(len(at), -1)):
                    leaf[at[which]] = numbers
                    for w, n, d in zip(at[which].tolist(), numbers.tolist(), distances.tolist(), strict=True):
                        path[w].append(n)
                        away[w].append(d)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "unit")), pa.array(leaf), pa.array(path, pa.list_(pa.int64())), pa.array(away, pa.list_(pa.float64()))], names=["id", "n", "unit", "leaf", "path", "away"])

    settled = materialize(leads.mapInArrow(place_rows, "id long, n long, unit binary, leaf long, path array<long>, away array<double>"), "settled")
    ways = settled.select("id", "n", F.explode(F.arrays_zip("path", "away")).alias("of")).groupBy("of.path")
    seen = ways.agg(F.max("of.away").alias("radius"), F.sum("n").alias("n"), F.count("*").alias("classes"), F.min("id").alias("least")).collect()  # one row per node of the sampled tree
    radii, (least_id, weight, classes_below) = np.full(len(nodes), -1.0), np.zeros((3, len(nodes)), np.int64)
    for r in seen:
        radii[r["path"]], least_id[r["path"]], weight[r["path"]], classes_below[r["path"]] = r["radius"], r["least"], r["n"], r["classes"]
    counts = {r["leaf"]: r["count"] for r in settled.groupBy("leaf").count().collect()}  # one row per leaf
    compared, linked = traverse(nodes, radii, reach, classes_below)
    size = min(LARGEST_TILE, max(SMALLEST_TILE, total // LEAST_GROUPS))
    of, cuts, pairs = meetings(nodes, compared, linked, counts, size)
    sides = [(a, b, cuts[a], cuts[b], a, 0) for a, b in pairs] + [(a, b, cuts[a], cuts[b], b, 1) for a, b in pairs]
    spark = vectors.sparkSession
    # of the size of the sampled tree: one row per leaf, and two per pair of bundles of leaves
    bundles = spark.createDataFrame(sorted(of.items()), "leaf long, bundle long")
    meets = spark.createDataFrame(sides, "a long, b long, cuts_a long, cuts_b long, bundle long, side int")
    mine = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, F.col("cuts_a")).otherwise(F.col("cuts_b")))
    bundled = settled.select("id", "n", "unit", "leaf").join(F.broadcast(bundles), "leaf")
    met = bundled.join(F.broadcast(meets), "bundle").withColumn("mine", mine)
    theirs = F.when(F.col("side") == 0, F.col("cuts_b")).otherwise(F.col("cuts_a"))
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), theirs - 1)))
    x, y = F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("other")), F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("mine"))
    tiles = spread.select("a", "b", x.alias("x"), y.alias("y"), "side", "id", "n", "unit").where("a != b or x < y or (x = y and side = 0)")

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        a, b, x, y = tile.loc[tile.index[0], ["a", "b", "x", "y"]]
        first = tile[tile["side"] == 0]
        second = None if (a, x) == (b, y) else tile[tile["side"] == 1]
        if not len(first) or (second is not None and not len(second)):
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        return tile_links(first, second, least)

    found = materialize(tiles.groupBy("a", "b", "x", "y").applyInPandas(compare, "id long, links long, root long"), "tile-links")
    # nodes of counted pairs: how many vectors a class below is linked with at once, and the smallest class that it so reaches
    group = roots_of(linked, least_id)
    sure = np.zeros(len(nodes), np.int64)
    np.add.at(sure, linked[:, 0], weight[linked[:, 1]])
    np.add.at(sure, linked[linked[:, 0] != linked[:, 1], 1], weight[linked[linked[:, 0] != linked[:, 1], 0]])
    own = set(linked[linked[:, 0] == linked[:, 1], 0].tolist())
    told = [(k, int(sure[k]), k in own, g) for k, g in sorted(group.items())]
    counted = spark.createDataFrame(told, "node long, sure long, own boolean, root long")
    at_once = settled.select("id", "n", F.explode("path").alias("node")).join(F.broadcast(counted), "node")
    at_once = at_once.select("id", (F.col("sure") - F.when(F.col("own"), F.col("n")).otherwise(0)).alias("links"), "root")
    found = found.union(at_once)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, "id", "left").join(parts, classes.id == parts.node, "left")
    named = materialize(named.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "vector-components")
    told = linkable.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where("vec_id is null or key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.union(alone)
