"""Candidate pairs from sorted signature orders, and their exact confirmation.

A row is one item in one order (tree or band): four nested prefix keys k0 to k3, each a hash of more
of the signature than the one before. Rows are dealt by k0 and sorted by all keys, so that a region
with a common prefix lies together, and rows with longer common prefixes lie closer. The first rows of
a region, WINDOW of them, meet one another; a later row meets the one before it, whose common prefix
with it is the longest, and the first rows of its region at the least and at the greatest depth. So
small regions give all their pairs. Batches stream through with the last rows and the region heads carried
over; no region is held in memory.

A region with over a thousandth of all rows is dealt by its deeper keys instead, and each of its rows
also meets one member common to all of them. There are under a thousand such regions, whatever the data.

In these first pairs crowded regions, those of more than WINDOW rows, link only near rows of the order. So their rows
are returned too, and ``joined`` compares all of a region's rows that aren't in one component yet, exactly
and in tiles. Together every two similar rows of a region end in one component, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.components import components
from seamark.llm.storage import materialize

WINDOW = 8
KEYS = ("k0", "k1", "k2", "k3")
HOT_SHARE, SAMPLED = 1000, 32


def hot_regions(some: DataFrame) -> DataFrame:
    """Regions with about a thousandth of all rows or more, with a member each; judged on the rows of a share of the items."""
    least = max(64, some.count() // HOT_SHARE)
    counted = some.groupBy("k0").agg(F.count("*").alias("n"), F.min(F.struct("id", "size")).alias("member")).where(F.col("n") >= least)
    return materialize(counted.select("k0", F.col("member.id").alias("hot_id"), F.col("member.size").alias("hot_size")), "hot")


def candidate_pairs(items: DataFrame, expand: Callable[[DataFrame], DataFrame], percent: int, keys: tuple[str, ...] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs a < b of items whose set sizes allow ``percent`` similarity, and the rows (k0, id) of crowded regions.

    ``items`` has an id, and ``expand`` gives the rows of items: the keys, id and size.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "id", "size", "hot_id", "hot_size"]
        past = {n: np.empty(0, np.int64) for n in names}
        heads: dict[str, tuple[int, int, int, int]] = {}  # of the region that the last row is in: key, first id and size, rows so far
        for batch in batches:
            if not len(batch):
                continue
            old = len(past["id"])
            col = {n: np.concatenate([past[n], batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64)]) for n in names}
            ids, sizes, total = col["id"], col["size"], len(col["id"])
            found: list[tuple[np.ndarray, ...]] = []
            new = np.arange(old, total)
            for k in (keys[0], keys[-1]):
                key = col[k][old:]
                first = np.r_[True, key[1:] != key[:-1]]
                start = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
                head, head_size, place = ids[new][start], sizes[new][start], np.arange(len(key)) - start
                if k in heads and heads[k][0] == key[0]:
                    begun = start == 0
                    head, head_size, place = np.where(begun, heads[k][1], head), np.where(begun, heads[k][2], head_size), place + begun * heads[k][3]
                heads[k] = (int(key[-1]), int(head[-1]), int(head_size[-1]), int(place[-1]) + 1)
                found.append((ids[new], head, sizes[new], head_size))
                if k == keys[0]:
                    for back in range(1, WINDOW + 1):
                        at = new[(place >= back) & ((place < WINDOW) | (back == 1))]
                        found.append((ids[at], ids[at - back], sizes[at], sizes[at - back]))
                    ninth = new[place == WINDOW]
                    crowd = np.unique(np.concatenate([new[(place >= WINDOW) | (col["hot_size"][new] > 0)], *(ninth - back for back in range(1, WINDOW + 1))]))
            hot = new[col["hot_size"][new] > 0]
            found.append((ids[hot], col["hot_id"][hot], sizes[hot], col["hot_size"][hot]))
            a, b, sa, sb = (np.concatenate(x) for x in zip(*found, strict=True))
            good = (a != b) & (100 * np.minimum(sa, sb) >= percent * np.maximum(sa, sb))
            pairs = np.unique(np.stack([np.minimum(a, b)[good], np.maximum(a, b)[good]], axis=1), axis=0)
            past = {n: v[-WINDOW:] for n, v in col.items()}
            rows = [np.r_[pairs[:, 0], ids[crowd]], np.r_[pairs[:, 1], ids[crowd]], np.r_[np.zeros(len(pairs), np.int64), col[keys[0]][crowd]]]
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["a", "b", "k0"])

    some = items.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(SAMPLED)) == 0)
    hot = hot_regions(materialize(expand(some).select("k0", "id", "size"), "some-rows"))
    told = expand(items).join(F.broadcast(hot), "k0", "left")  # under a thousand rows, or HOT_SHARE regions at most
    told = told.select(*keys, "id", "size", F.coalesce("hot_id", F.lit(0)).alias("hot_id"), F.coalesce("hot_size", F.lit(0)).alias("hot_size"))
    deal = F.when(F.col("hot_size") > 0, F.xxhash64("k0", keys[len(keys) // 2])).otherwise(F.col("k0"))
    met = told.repartition(deal).sortWithinPartitions(*keys, "id").mapInArrow(meet, "a long, b long, k0 long").distinct()
    met = materialize(met, "met")  # a row of a crowded region has a = b
    return met.where("a != b").select("a", "b"), met.where("a = b").select("k0", F.col("a").alias("id"))


def bucket_pairs(items: DataFrame, expand: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs a < b of items in buckets of up to WINDOW items, and the rows (k0, id) of all larger buckets.

    ``expand`` gives the rows (k0, id) of items, in which an item may come several times. Rows are sorted by k0
    alone, and stream through with the first rows of the last bucket carried over. Hot buckets are dealt anywhere.
    """

    some = items.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(SAMPLED)) == 0)
    some = materialize(expand(some).select("k0", "id", F.lit(1).alias("size")), "some-rows")
    hot_keys = np.array([r["k0"] for r in hot_regions(some.distinct()).select("k0").collect()], np.int64)  # under a thousand

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_id = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            key, item = (np.concatenate([held, batch.column(c).to_numpy()]) for c, held in (("k0", held_key), ("id", held_id)))
            order = np.lexsort((item, key))
            key, item = key[order], item[order]
            new = np.r_[True, (key[1:] != key[:-1]) | (item[1:] != item[:-1])]
            key, item = key[new], item[new]
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            number = np.diff(np.r_[start, len(key)])
            size, place = np.repeat(number, number), np.arange(len(key)) - np.repeat(start, number)
            crowd = (size > WINDOW) | np.isin(key, hot_keys)
            pairs = [(at - back, at) for back in range(1, WINDOW) if len(at := np.flatnonzero((place >= back) & ~crowd))]
            low, high = (np.concatenate([p[side] for p in pairs]) if pairs else np.empty(0, np.int64) for side in (0, 1))
            held_key, held_id = key[start[-1] :][: WINDOW + 1], item[start[-1] :][: WINDOW + 1]
            columns = np.r_[item[low], item[crowd]], np.r_[item[high], item[crowd]], np.r_[np.zeros(len(low), np.int64), key[crowd]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "k0"])

    deal = F.when(F.col("k0").isin(hot_keys.tolist()), F.xxhash64("k0", "id")).otherwise(F.col("k0"))
    met = expand(items).select("k0", "id").repartition(deal).sortWithinPartitions("k0").mapInArrow(meet, "a long, b long, k0 long").distinct()
    met = materialize(met, "met")
    return met.where("a != b").select("a", "b"), met.where("a = b").select("k0", F.col("a").alias("id"))


def distinct_by_owner(values: np.ndarray, owner: np.ndarray, owners: int) -> list[np.ndarray]:
    """Sorted distinct values of each owner. Of the 64 bits the highest stay, as many as the owner's number leaves."""
    bits = np.uint64(max(1, int(owners).bit_length()))
    keys = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (values >> bits))
    keys = keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]
    bounds = np.searchsorted(keys, np.arange(1, owners, dtype=np.uint64) << (np.uint64(64) - bits))
    return np.split(keys << bits, bounds)


def overlaps(x: list[np.ndarray], y: list[np.ndarray], most: int = 1 << 21) -> np.ndarray:
    """Sizes of the intersections of x[i] and y[i], sets of 64-bit hashes; compared in 51 bits or more."""
    sizes = np.array([len(v) for v in x]) + np.array([len(v) for v in y])
    parts = np.maximum(np.cumsum(sizes) // most, np.arange(len(x)) // 8192) if len(x) else sizes
    found = np.zeros(len(x), np.int64)
    for some in np.split(np.arange(len(x)), np.flatnonzero(np.diff(parts)) + 1) if len(x) else []:
        bits = np.uint64(max(1, len(some).bit_length()))
        owner = np.repeat(np.arange(len(some), dtype=np.uint64), sizes[some]) << (np.uint64(64) - bits)
        keys = np.sort(owner | (np.concatenate([v for i in some for v in (x[i], y[i])]) >> bits))
        twice = keys[1:][keys[1:] == keys[:-1]] >> (np.uint64(64) - bits)
        found[some] = np.bincount(twice.astype(np.int64), minlength=len(some))
    return found


def estimate_filter(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Keeps pairs whose sketches (id, bits: a byte for each hash) agree in a share of at least ``least`` of the bytes."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1) for c in ("x", "y"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    left, right = (sketches.select(F.col("id").alias(n), F.col("bits").alias(c)) for n, c in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(agree, "a long, b long")


def confirm(pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame], to_sets: Callable[[list[bytes]], list[np.ndarray]], percent: int, cut: int = 64, together: int = 2000, possible: Callable[[list[bytes], np.ndarray, np.ndarray, int], np.ndarray] | None = None) -> DataFrame:
    """The pairs whose sets have 100 * intersection >= percent * union.

    ``possible`` tells which pairs of data, by their places, aren't ruled out by a bound that is cheaper than sets; only these are compared.

    ``pairs`` is a materialised table. Pairs are dealt by their smaller end, of many pairs in salted parts, to blocks of
    about ``together`` pairs, so that an item's data goes to a block once, not once a pair. ``fetch`` takes rows
    (id, blocks) and returns (id, blocks, data).
    """
    cuts = pairs.groupBy("a").agg(F.ceil(F.count("*") / cut).alias("cuts")).where("cuts > 1")
    salted = pairs.join(materialize(cuts, "cuts"), "a", "left")
    blocks = max(64, pairs.count() // together)
    part = F.xxhash64("a", F.when(F.col("cuts").isNotNull(), F.pmod(F.xxhash64("b"), F.col("cuts"))))
    placed = materialize(salted.select("a", "b", F.pmod(part, F.lit(blocks)).alias("block")), "placed")
    wanted = placed.select(F.col("a").alias("id"), "block").union(placed.select("b", "block")).groupBy("id").agg(F.collect_set("block").alias("blocks"))
    data = fetch(materialize(wanted, "wanted")).select(F.explode("blocks").alias("block"), "id", "data")

    def check(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.drop_duplicates("id", keep="last")
        if possible:
            at = pd.Series(np.arange(len(right)), index=right["id"])
            left = left[possible(list(right["data"]), at[left["a"]].to_numpy(), at[left["b"]].to_numpy(), percent)]
            right = right[right["id"].isin(np.union1d(left["a"], left["b"]))]
        if not len(left):
            return left[["a", "b"]]
        sets = dict(zip(right["id"], to_sets(list(right["data"])), strict=True))
        size = {i: len(v) for i, v in sets.items()}
        a, b = (left[c].map(size).to_numpy() for c in "ab")
        left = left[100 * np.minimum(a, b) >= percent * np.maximum(a, b)]
        both = overlaps([sets[i] for i in left["a"]], [sets[i] for i in left["b"]])
        total = left["a"].map(size).to_numpy() + left["b"].map(size).to_numpy() - both
        return left.loc[(both > 0) & (100 * both >= percent * total), ["a", "b"]]

    return placed.groupBy("block").cogroup(data.groupBy("block")).applyInPandas(check, "a long, b long")


def intersections(x: list[np.ndarray], y: list[np.ndarray], most: int = 1 << 22) -> np.ndarray:
    """Sizes of the intersections of each set of ``x`` with each of ``y``: products for common members, expanded pairs for rare ones."""
    values, where = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    owner = np.repeat(np.arange(len(x) + len(y)), [len(v) for v in (*x, *y)])
    ours = owner < len(x)
    mine, theirs = (np.bincount(where[side], minlength=len(values)) for side in (ours, ~ours))
    heavy = 128 * mine * theirs > len(x) * len(y)
    both = np.zeros((len(x), len(y)), np.float32)
    common = np.flatnonzero(heavy)
    for low in range(0, len(common), 4096):
        column = np.full(len(values), -1, np.int64)
        column[common[low : low + 4096]] = np.arange(len(common[low : low + 4096]))
        of = column[where]
        dense = np.zeros((len(x) + len(y), len(common[low : low + 4096])), np.float32)
        dense[owner[of >= 0], of[of >= 0]] = 1
        both += dense[: len(x)] @ dense[len(x) :].T
    rare = (mine > 0) & (theirs > 0) & ~heavy
    right = np.flatnonzero(~ours & rare[where])
    right = right[np.argsort(where[right], kind="stable")]
    begin = np.cumsum(theirs * rare) - theirs * rare
    left = np.flatnonzero(ours & rare[where])
    step = np.cumsum(theirs[where[left]]) // most
    for part in np.split(left, np.flatnonzero(np.diff(step)) + 1) if len(left) else []:
        times = theirs[where[part]]
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin[where[part]], times)
        cell = np.repeat(owner[part], times) * len(y) + owner[right[at]] - len(x)
        both += np.bincount(cell, minlength=both.size).reshape(both.shape)
    return both


def spanning(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what ``pairs`` connect, one less than there are nodes at most."""
    parent: dict[int, int] = {}

    def top(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    kept = []
    for a, b in pairs.tolist():
        one, two = top(a), top(b)
        if one != two:
            parent[max(one, two)] = min(one, two)
            kept.append((a, b))
    return kept


def tiles_of(members: DataFrame, block: int) -> DataFrame:
    """Rows (tile, side, id, component) of regions with several components: every two rows of different components share a tile.

    A component with ``block`` rows or more in a region has blocks of its own, the others share some; blocks are cut by hashes of ids.
    A tile is two blocks of a region, but not two of one component. Of regions with the same rows one is taken.
    """
    counted = materialize(members.groupBy("k0", "component").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")), "region-parts")
    whole = counted.groupBy("k0").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).where("kinds > 1")
    regions = materialize(whole.groupBy("n", "x", "y").agg(F.min("k0").alias("k0")).select("k0"), "regions")
    owner = F.when(F.col("n") >= block, F.col("component"))
    owned = counted.join(regions, "k0", "left_semi").select("k0", "component", "n", owner.isNull().alias("shared"), F.coalesce(owner, F.lit(0)).alias("owner"))
    cuts = owned.groupBy("k0", "shared", "owner").agg(F.ceil(F.sum("n") / block).alias("cuts"))
    cuts = materialize(cuts, "region-cuts")
    name = F.xxhash64("k0", "shared", "owner", "cut")
    blocks = cuts.select("k0", "shared", "owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut")).select("k0", "shared", "owner", name.alias("block"))
    x, y = (blocks.select("k0", *(F.col(c).alias(f"{c}_{n}") for c in ("shared", "owner", "block"))) for n in "xy")
    apart = (F.col("block_x") <= F.col("block_y")) & (F.col("shared_x") | F.col("shared_y") | (F.col("owner_x") != F.col("owner_y")))
    tiles = x.join(y, "k0").where(apart).select(F.xxhash64("block_x", "block_y").alias("tile"), "block_x", "block_y")
    tiles = materialize(tiles, "tiles")
    sides = tiles.select("tile", F.lit(0).alias("side"), F.col("block_x").alias("block")).union(tiles.where("block_x != block_y").select("tile", F.lit(1), "block_y"))
    kinds = materialize(owned.join(cuts, ["k0", "shared", "owner"]).select("k0", "component", "shared", "owner", "cuts"), "region-kinds")
    rows = members.join(kinds, ["k0", "component"])
    cut = F.pmod(F.xxhash64("id", F.lit(2)), F.col("cuts"))
    return rows.withColumn("cut", cut).select(name.alias("block"), "id", "component").join(sides, "block").select("tile", "side", "id", "component")


def joined(parts: DataFrame, members: DataFrame, fetch: Callable[[DataFrame], DataFrame], to_sets: Callable[[list[bytes]], list[np.ndarray]], percent: int, block: int = 256, together: int = 1024) -> DataFrame:
    """``parts``, components (node, component) by first links, joined by all links between rows of crowded regions.

    ``members`` are the regions' rows (k0, id); ``fetch`` and ``to_sets`` are those of ``confirm``.
    """
    named = members.join(parts.withColumnRenamed("node", "id"), "id", "left").select("k0", "id", F.coalesce("component", "id").alias("component"))
    placed = materialize(tiles_of(materialize(named, "crowded"), block), "tiled")
    rows = placed.count()
    if not rows:
        return parts
    batches = max(64, rows // together)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("tile"), F.lit(batches)))
    wanted = materialize(placed.groupBy("id").agg(F.collect_set("block").alias("blocks")), "tile-wanted")
    data = fetch(wanted).select(F.explode("blocks").alias("block"), "id", "data")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        sets = dict(zip(right["id"], to_sets(list(right["data"])), strict=True))
        kept = []
        for _, rows in left.groupby("tile"):
            sides = [rows[rows["side"] == n] for n in (0, 1)]
            one, two = sides if len(sides[1]) else (rows, rows)
            if not len(one):
                continue
            x, y = ([sets[i] for i in side["id"]] for side in (one, two))
            c, d = one["component"].to_numpy(), two["component"].to_numpy()
            p, q = np.array([len(v) for v in x]), np.array([len(v) for v in y])
            able = (c[:, None] != d) & (100 * np.minimum(p[:, None], q) >= percent * np.maximum(p[:, None], q))
            u, v = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
            if not len(u):
                continue
            both = intersections([x[i] for i in u], [y[i] for i in v]).astype(np.int64)
            good = able[np.ix_(u, v)] & (both > 0) & (100 * both >= percent * (p[u][:, None] + q[v] - both))
            i, j = np.nonzero(good)
            kept += spanning(np.unique(np.stack([c[u][i], d[v][j]], axis=1), axis=0))
        return pd.DataFrame(kept, columns=["a", "b"], dtype="int64")

    across = materialize(placed.groupBy("block").cogroup(data.groupBy("block")).applyInPandas(compare, "a long, b long"), "across")
    if across.isEmpty():
        return parts
    higher = components(across).select(F.col("node").alias("part"), F.col("component").alias("root"))
    higher = materialize(higher, "higher")
    moved = parts.join(higher.withColumnRenamed("part", "component"), "component", "left")
    return materialize(moved.select("node", F.coalesce("root", "component").alias("component")).union(higher), "joined")


def prefixes(items: DataFrame, orders: int, width: int, depths: tuple[int, ...]) -> DataFrame:
    """Rows (k0..k3, id, size): for each order, hashes of the first ``depths`` values of the signature, read in a cycle from ``width`` times the order."""
    rows = items.select("id", "size", F.concat("signature", "signature").alias("cycle"), F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("order"))
    done, last = 0, F.col("order")
    for key, depth in zip(KEYS, depths, strict=True):
        rows = rows.withColumn(key, F.xxhash64(last, F.slice("cycle", F.col("order") * width + (done + 1), depth - done)))
        done, last = depth, F.col(key)
    return rows.select(*KEYS, "id", "size")
