"""Carried timestamps and reassembly against models that read line by line."""

import random

from seamark.operators import ordering


def model_times(rows):
    """rows: (kind, own) in order; the time of each, with arrival 1000 + place."""
    pending, out = None, []
    for n, (kind, own) in enumerate(rows):
        arrival = 1000 + n
        if kind == "capture":
            pending = own
            out.append(own)
        elif kind == "text":
            pending = None
            out.append(arrival)
        else:
            ts = own if own else pending if pending else arrival
            if own:
                pending = own if kind != "single" else None
            elif kind in ("single", "last"):
                pending = None
            out.append(ts)
    return out


def line_of(kind, own, n):
    body = {"single": "!AIVDM,1,1,,A,15,0*00", "first": f"!AIVDM,2,1,{n % 10},A,15,0*00", "last": f"!AIVDM,2,2,{n % 10},A,15,0*00", "text": "hello"}.get(kind)
    if kind == "capture":
        return f"$PGHP,1,2013,1,9,4,37,{own // 1000 % 60},298,,110,,1,26*19"
    return f"\\c:{own // 1000}*00\\{body}" if own else body


def test_timestamps_against_model(spark):
    rng, data, want = random.Random(5), [], {}
    for source in range(40):
        rows = []
        for _ in range(30):
            kind = rng.choice(["single", "first", "last", "text", "capture"])
            own = 1357706220298 + rng.randrange(60) * 1000 if kind == "capture" else rng.choice([0, 0, rng.randrange(1, 10**9) * 1000]) if kind != "text" else 0
            rows.append((kind, own))
        times = model_times(rows)
        for n, (kind, own) in enumerate(rows):
            data.append((f"s{source}", n, 1000 + n, line_of(kind, own, n)))
            want[f"s{source}", n] = times[n]
    df = spark.createDataFrame(data, "source string, line long, arrival_ms long, payload string")
    got = {(r.source, r.line): r.ts_ms for r in ordering.resolve_timestamps(df).collect()}
    assert got == want


def test_sequence_ids_come_again(spark):
    data = []
    for message in range(20):
        for number in (1, 2, 3):
            data.append(("x", message * 3 + number, 5000 + message, f"!AIVDM,3,{number},{message % 2},A,{message:02d}{number},0*00"))
    df = spark.createDataFrame(data, "source string, line long, ts_ms long, payload string")
    rows = ordering.reassemble(df).orderBy("line").collect()
    assert len(rows) == 20 and all(r.complete for r in rows)
    assert [r.payload.split(",")[5] for r in rows] == [f"{m:02d}1{m:02d}2{m:02d}3" for m in range(20)]


def test_missing_fragment_passes_parts(spark):
    df = spark.createDataFrame([("x", 1, 9, "!AIVDM,2,1,4,A,11,0*00"), ("y", 1, 9, "!AIVDM,2,2,4,A,22,0*00")], "source string, line long, ts_ms long, payload string")
    assert sorted((r.source, r.complete, r.payload) for r in ordering.reassemble(df).collect()) == [("x", False, "!AIVDM,2,1,4,A,11,0*00"), ("y", False, "!AIVDM,2,2,4,A,22,0*00")]


def model_messages(rows, timeout):
    """(line, ts_ms, armor or fragment, complete) of rows (group, number, count, line, ts_ms, armor), read one by one."""
    open_, out = {}, []

    def give_up(g):
        m = open_.pop(g)
        out.extend((own, m["ts"], a, False) for _, (a, own) in sorted(m["slots"].items()))

    for g, number, count, line, ts, armor in rows:
        if g in open_ and ts - open_[g]["ts"] > timeout:
            give_up(g)
        m = open_.setdefault(g, {"line": line, "ts": ts, "slots": {}})
        if 1 <= number <= count and number not in m["slots"]:
            m["slots"][number] = (armor, line)
        if len(m["slots"]) == count:
            out.append((m["line"], m["ts"], "".join(a for _, (a, _) in sorted(m["slots"].items())), True))
            del open_[g]
    for g in list(open_):
        give_up(g)
    return sorted(out)


SCHEMA = "source string, line long, ts_ms long, payload string"


def sentences_armor(payload):
    return payload[payload.index("!") :].split(",")[5]


def shuffled_fragments(seed):
    """Lines of three groups of two to four fragments: in any order, twice, missing, out of range, and their ids used again."""
    rng, rows, ts = random.Random(seed), [], 1_700_000_000_000
    for message in range(300):
        count, sid = rng.choice([2, 2, 3, 4]), rng.choice([1, 2])
        numbers = [n for n in range(1, count + 1) if rng.random() > 0.1] + ([rng.randint(0, count + 1)] if rng.random() < 0.3 else [])
        rng.shuffle(numbers)
        ts += rng.choice([0, 400, 3000])
        for n in numbers:
            rows.append((count * 10 + sid, n, count, len(rows), ts + rng.choice([0, 0, 5, -200]), f"{message:03d}{n}"))
    return rows


def as_lines(rows):
    return [("x", line, ts, f"!AIVDM,{count},{number},{g % 10},A,{armor},0*00") for g, number, count, line, ts, armor in rows]


def test_shuffled_fragments_against_a_model(spark):
    for timeout in (1000, 600_000):
        rows = shuffled_fragments(timeout)
        found = ordering.reassemble(spark.createDataFrame(as_lines(rows), SCHEMA).repartition(3), timeout_ms=timeout).collect()
        assert sorted((r.line, r.ts_ms, sentences_armor(r.payload), r.complete) for r in found) == model_messages(rows, timeout)


def test_two_orders_that_were_wrong(spark):
    for numbers in ((2, 1), (1, 3, 2), (3, 1, 2)):
        rows = [(31, n, len(numbers), k, 1000, f"p{n}") for k, n in enumerate(numbers)]
        [row] = ordering.reassemble(spark.createDataFrame(as_lines(rows), SCHEMA)).collect()
        assert row.complete and sentences_armor(row.payload) == "".join(f"p{n}" for n in sorted(numbers)) and row.line == 0


def test_tags_are_of_the_first_to_come_and_broken_fragments_pass_apart(spark):
    lines = [
        ("x", 1, 50, "\\s:late,c:9*00\\!AIVDM,2,2,1,A,22,2*00"), ("x", 2, 60, "\\s:other*00\\!AIVDM,2,1,1,A,11,0*00"),
        ("x", 3, 70, "!AIVDM,2,1,2,A"), ("x", 4, 80, "!AIVDM,2,2,2,A"), ("x", 5, 90, "!AIVDM,2,x,3,A,33,0*00"), ("x", 6, 95, "!AIVDM,2,2,3,A,44,1*00"),
    ]
    got = {r.line: r for r in ordering.reassemble(spark.createDataFrame(lines, SCHEMA)).where("complete").collect()}
    assert got[1].payload.startswith("\\c:9,s:late*") and "!AIVDM,1,1,,A,1122,2*" in got[1].payload and got[1].ts_ms == 50
    assert "!AIVDM,1,1,,A,3344,1*" in got[5].payload
    broken = ordering.reassemble(spark.createDataFrame(lines, SCHEMA)).where("not complete").orderBy("line").collect()
    assert [(r.payload, r.complete) for r in broken] == [("!AIVDM,2,1,2,A", False), ("!AIVDM,2,2,2,A", False)]
