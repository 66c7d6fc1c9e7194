"""Prefix trie of conversations: what many conversations begin with is one node.

A conversation's turns, in order, are its positions; each position holds a turn id, 128 bits of role and text, so
texts are read once and never shuffled. A row holds a block of ``WIDTH`` positions as columns, and one ROLLUP over
these columns aggregates the prefixes of all blocks of all conversations together: grouping_id tells the depth, and a
block is keyed by the node at which the block before ended. Long conversations so take more rows, not more jobs.
A node's name is that key: 128 bits combined from the hashes of all (position, turn id) up to it.

Sums over subtrees need no walk. The smallest member of a node owns it, and what a conversation owns is the rest of its
path from some depth on. So a subtree's distinct bytes and its leaves are sums, over the members, of what each of them
owns, less what the owner of the top owns above it: a second ROLLUP, over conversations that own something.

Turns are in the order of turn, nulls first; equal ones by turn id. Null roles and texts are empty. Rows with a null
conversation belong to none and are left out. Repeated rows are turns of their own. A conversation's rows of up to 1024
consecutive turn numbers are ranked in one task, which spills; nothing gathers a conversation, a node's members or the
ends of a popular node: a node's ends are joined in segments of 4096 numbers, and segments stream through its hash.
Without conversations there is no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.storage import materialize

WIDTH = 8
RANKED, SEGMENT = 10, 12  # as powers of two


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, p (from 1), turn_id and bytes of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_id = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.col("turn").cast("long")
    found = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.shiftright(turn, RANKED).alias("bucket"), turn_id.alias("turn_id"), F.octet_length(text).cast("long").alias("bytes")
    )
    found = materialize(found, "turns")
    within = F.row_number().over(Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "turn_id"))
    before = Window.partitionBy("conv_id").orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = found.groupBy("conv_id", "bucket").agg(F.count("*").alias("n"))
    # conversations of one bucket, nearly all, have no row here
    bases = counts.select(F.col("conv_id").alias("of"), F.col("bucket").alias("part"), F.sum("n").over(before).alias("base")).where("base > 0")
    ranked = found.withColumn("within", within).join(bases, (F.col("conv_id") == F.col("of")) & F.col("bucket").eqNullSafe(F.col("part")), "left")
    return ranked.select("conv_id", (F.col("within") + F.coalesce("base", F.lit(0))).alias("p"), "turn_id", "bytes")


def with_shared_heads(turns: DataFrame, group: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations, and one row for each of these with its number of turns.

    A conversation c gets the first h turns of c - c % group (all if it has fewer, none if there is no such one) in place
    of its own first h, where h = crc32(c) % (most + 1).
    """
    h = lambda c: F.crc32(c.cast("string")) % (most + 1)
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(bases, "base", "left")
    h_of = h(F.col("conv_id"))
    convs = convs.withColumn("head", F.least(h_of, F.coalesce("base_turns", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "head", (F.col("head") + F.greatest(F.col("own") - h_of, F.lit(0))).alias("turns")), "rebuilt")
    heads = turns.where(F.col("p") <= most).withColumnRenamed("conv_id", "base").join(convs, "base").where("p <= head").select("conv_id", "p", "turn_id", "bytes")
    rest = turns.where(F.col("p") > h_of).join(convs.select("conv_id", "head"), "conv_id")
    rest = rest.select("conv_id", (F.col("p") - h_of + F.col("head")).alias("p"), "turn_id", "bytes")
    return heads.union(rest), convs.select("conv_id", "turns")


def named(seed: int, position: Column, turn_id: Column) -> Column:
    return F.xxhash64(F.lit(seed), position.cast("long"), turn_id)


def blocks_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each block of a conversation: hi, lo and before (name and bytes of all before it), all (bytes of the whole), last, and the columns t1.., b1..; a conversation without turns has one of nulls."""
    part = F.struct("p", "turn_id", "bytes")
    cut = turns.groupBy("conv_id", F.floor((F.col("p") - 1) / WIDTH).alias("block")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    folded = lambda seed: F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(named(seed, x["p"], x["turn_id"])))
    own = cut.select("*", folded(1).alias("own_hi"), folded(2).alias("own_lo"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["bytes"]).alias("own_bytes"))
    whole = Window.partitionBy("conv_id").orderBy("block")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda how, c: F.coalesce(how(c).over(before), F.lit(0)).cast("long")
    placed = own.select(
        "conv_id", "block", upto(F.bit_xor, "own_hi").alias("hi"), upto(F.bit_xor, "own_lo").alias("lo"), upto(F.sum, "own_bytes").alias("before"),
        F.sum("own_bytes").over(Window.partitionBy("conv_id")).alias("all"), F.lead("block").over(whole).isNull().alias("last"),
        *[F.get("parts", F.lit(j))["turn_id"].alias(f"t{j + 1}") for j in range(WIDTH)], *[F.get("parts", F.lit(j))["bytes"].alias(f"b{j + 1}") for j in range(WIDTH)],
    )
    zeros = {c: F.lit(0).cast("long") for c in ("block", "hi", "lo", "before", "all")}
    turnless = convs.where("turns = 0").select("conv_id", *[v.alias(c) for c, v in zeros.items()], F.lit(True).alias("last"))
    return placed.unionByName(turnless, allowMissingColumns=True)


def upto_depth(k: Column, value, start: Column) -> Column:
    """``start`` with the values of the first k columns folded in."""
    return reduce(lambda so_far, j: value(so_far, j, k >= j), range(1, WIDTH + 1), start)


def name_at(k: Column, start: str, seed: int) -> Column:
    position = lambda j: F.col("block") * WIDTH + j
    step = lambda a, j, on: a.bitwiseXOR(F.when(on & F.col(f"t{j}").isNotNull(), named(seed, position(j), F.col(f"t{j}"))).otherwise(F.lit(0)))
    return upto_depth(k, step, F.col(start))


def rolled_up(rows: DataFrame, sums: str) -> DataFrame:
    """All prefixes of all blocks with the aggregates ``sums``, and k, their positions in their block; a block's own start is a node for the first block only."""
    columns = ", ".join(f"t{j}" for j in range(1, WIDTH + 1))
    found = rows.sparkSession.sql(f"SELECT block, hi, lo, {columns}, {WIDTH} - bit_count(grouping_id()) AS k, {sums} FROM {{rows}} GROUP BY block, hi, lo, ROLLUP ({columns})", rows=rows)
    deepest = F.get(F.array(*[f"t{j}" for j in range(1, WIDTH + 1)]), F.col("k") - 1)
    return found.where(((F.col("k") == 0) & (F.col("block") == 0)) | deepest.isNotNull())


def nodes_of(rows: DataFrame) -> DataFrame:
    """hi, lo, up_hi, up_lo (the parent's name), depth, n_convs, owner, all, before (bytes above the last turn) of every node."""
    bytes_of = ", ".join(f"max(b{j}) AS b{j}" for j in range(1, WIDTH + 1))
    found = rolled_up(rows, f"count(*) AS n_convs, min(conv_id) AS owner, sum(all) AS all, max(before) AS before, {bytes_of}")
    k = F.col("k")
    above = upto_depth(k - 1, lambda a, j, on: a + F.when(on, F.coalesce(f"b{j}", F.lit(0))).otherwise(F.lit(0)), F.col("before"))
    return found.select(
        name_at(k, "hi", 1).alias("hi"), name_at(k, "lo", 2).alias("lo"), name_at(k - 1, "hi", 1).alias("up_hi"), name_at(k - 1, "lo", 2).alias("up_lo"),
        (F.col("block") * WIDTH + k).cast("long").alias("depth"), "n_convs", "owner", "all", above.alias("before"),
    )


def ends_of(rows: DataFrame) -> DataFrame:
    """hi, lo and ends_sha256 of the nodes at which a conversation ends."""
    ends = rows.where("last").select(name_at(F.lit(WIDTH), "hi", 1).alias("hi"), name_at(F.lit(WIDTH), "lo", 2).alias("lo"), "conv_id")
    segments = ends.groupBy("hi", "lo", F.shiftright("conv_id", SEGMENT).alias("segment")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by name and segment; one hash is open at a time."""
        now, hashed = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids")), strict=True):
                if (hi, lo) == now:
                    hashed.update(b",")
                else:
                    if now is not None:
                        done.append((*now, hashed.hexdigest()))
                    now, hashed = (hi, lo), hashlib.sha256()
                hashed.update(ids.encode())
            yield digests(done)
        if now is not None:
            yield digests([(*now, hashed.hexdigest())])

    dealt = segments.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "segment").select("hi", "lo", "ids")
    return dealt.mapInArrow(digest, "hi long, lo long, ends_sha256 string")


def digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    hi, lo, text = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(text, pa.string())], names=["hi", "lo", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` has conv_id, p, turn_id and bytes, and ``convs`` a row for each conversation with its number of turns.
    """
    rows = materialize(blocks_of(turns, convs), "blocks")
    nodes = materialize(nodes_of(rows), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["hi", "lo"], "left").fillna(0, ["n_children"])
    nodes = materialize(nodes, "parents")
    # what a conversation owns: from which bytes of its own on, and whether it ends in a leaf that is its own
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(F.min("before").alias("skipped"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    owned = rows.join(owners, "conv_id").withColumn("rest", F.col("all") - F.col("skipped"))
    below = rolled_up(owned, "sum(rest) AS rest, sum(leaf) AS n_leaves, min_by(skipped, conv_id) AS skipped")
    below = below.select(name_at(F.col("k"), "hi", 1).alias("hi"), name_at(F.col("k"), "lo", 2).alias("lo"), "rest", "n_leaves", "skipped")
    found = nodes.join(below, ["hi", "lo"]).join(ends_of(rows), ["hi", "lo"], "left")
    # the root, of which every other tree's top is a child, is one row
    up = lambda some: some.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("owner").alias("parent_conv_id"))
    low = found.where("depth > 1").join(up(nodes.where("depth > 0")), ["up_hi", "up_lo"])
    high = found.where("depth = 1").join(F.broadcast(up(nodes.where("depth = 0"))), ["up_hi", "up_lo"])
    top = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    told = low.unionByName(high).unionByName(top)
    distinct_bytes = F.col("rest") - (F.col("before") - F.col("skipped"))
    return told.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("all") - F.col("n_convs") * F.col("before") - distinct_bytes).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def trie_sql() -> str:
    crc = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda so_far, byte: list_reduce(list_prepend(xor(so_far, byte), CAST([0, 1, 2, 3, 4, 5, 6, 7] AS BIGINT[])), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
    return f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS g, {crc} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, p, r, x FROM c JOIN t ON t.conv_id = c.g AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND p > h
), s AS (
  SELECT c.conv_id, coalesce(list({{'r': r, 'x': x}} ORDER BY part, p) FILTER (WHERE part IS NOT NULL), []) AS turns FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), m AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM s
), n AS (
  SELECT turns[1:depth] AS key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL
), kids AS (SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.key[n.depth].x) END AS saved FROM n LEFT JOIN kids ON kids.key = n.key AND kids.depth = n.depth
), sums AS (
  SELECT key[1:d] AS key, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(depth + 1)) AS d FROM f) GROUP BY ALL
)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN sums ON sums.key = f.key AND sums.depth = f.depth LEFT JOIN n up ON up.depth = f.depth - 1 AND up.key = f.key[1:f.depth - 1]"""
