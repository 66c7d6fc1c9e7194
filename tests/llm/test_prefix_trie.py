"""The trie against a plain Python model: odd rows, long conversations and popular beginnings, and the query against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from seamark.llm import prefix_trie as trie
from seamark.llm import queries, registry


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def modelled(rows):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(turns[d - 1])
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in sorted(members, key=len, reverse=True):
        leaves[key] += not kids[key]
        if key:
            saved[key] += (len(members[key]) - 1) * len(key[-1][1].encode())
            leaves[key[:-1]] += leaves[key]
            saved[key[:-1]] += saved[key]
    return sorted(
        (min(some), len(key), min(members[key[:-1]]) if key else -1, len(some), len(kids[key]), leaves[key], saved[key], hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest())
        for key, some in members.items()
    )


def found(spark, rows):
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, hi int").repartition(3)
    got = trie.prefix_trie(*trie.with_shared_heads(trie.turns_of(table))).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def test_random_conversations(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(-7, 60), 10**12, 10**12 + 3, 97, 98, 99]:
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, turn * rng.choice([1, 1, 700]), rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é"])))
    seen = set()
    rows = [r for r in rows if (r[:2] not in seen, seen.add(r[:2]))[0]]
    rng.shuffle(rows)
    assert found(spark, rows) == modelled(rows)


def test_long_conversations_over_many_blocks_and_buckets(spark):
    rows = [(c, t * 3, "u", "x" * (t % 5) + ("" if t < cut else str(c))) for c, n, cut in [(5, 300, 400), (6, 300, 290), (7, 290, 400), (8, 1100, 64), (9, 64, 64), (10, 65, 72), (11, 16, 16), (13, 1300, 8)] for t in range(n)]
    assert found(spark, rows) == modelled(rows)


def test_one_popular_conversation_and_ends_over_many_segments(spark):
    rows = [(5 * c * 700, 0, "u", "same") for c in range(900)] + [(5 * c * 700, 1, "a", "also") for c in range(0, 900, 3)]
    want = modelled(rows)
    assert found(spark, rows) == want
    assert max(r[3] for r in want) == 900


def test_nulls_repeats_and_equal_turns(spark):
    rows = [(None, 0, "u", "lost"), (1, None, "u", "first"), (1, 0, "u", "x"), (2, 0, None, None), (3, 0, "", ""), (12, 0, "a", "bc"), (13, 0, "ab", "c")]
    assert found(spark, rows) == modelled(rows)
    twice = [(20, 0, "u", "x"), (20, 0, "u", "x")] * 6
    assert found(spark, twice) == modelled(twice)


def test_no_conversations(spark):
    assert found(spark, [(None, 0, "u", "x")]) == []


def test_query_equals_sql(spark, sf_dir):
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    frame = queries.op13_prefix_trie(spark, sf_dir)
    want = db.sql(f"select {', '.join(frame.columns)} from ({registry.oracle_sql()['op13_prefix_trie']})").fetchall()
    order = lambda rows: sorted(tuple(-1 if v is None else v for v in r) for r in rows)
    assert order(frame.collect()) == order(want)
    assert {str(t) for t in db.sql(registry.oracle_sql()["op13_prefix_trie"]).types} == {"BIGINT", "VARCHAR"}
