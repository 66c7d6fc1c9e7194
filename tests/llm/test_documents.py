"""Operators on documents against brute force, with nulls, blanks, repeats and clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seamark.llm import langid, licenses, line_dedup, mixing, near_dups, neighbours, packing, quality, storage, token_files, tokens, wordhash
from seamark.llm.tokens import encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, size int"
ODD = [None, "", " ", "\n", "a", "one two", "a  b\n\n c ", "été É\tx", "x" * 30_000, "a,b.c, d.. e", "<|endoftext|> z", "1.5 'tis it's\u00a0x"]


def documents(spark, texts, partitions=3):
    rows = [(None if i == 3 else i, t, ["en", "fr", None][i % 3], ["b", "a", None, "c"][i % 4], len(t or ""), 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def random_texts(n, seed=1, vocabulary=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(rng.randint(1, 120))) for _ in range(n)]


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    texts = ODD + random_texts(40)
    rng = random.Random(4)
    texts += ["".join(rng.choice("ab.,' \n\té1_\u00a0") for _ in range(40)) for _ in range(300)]
    texts += ["".join(rng.choice("ab. A\n,é<|\0İ") for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    got = encoder(path, 7).encode(pa.array(texts, pa.string())).to_pylist()
    for text, coded in zip(texts, got, strict=True):
        assert coded == [*whole.encode(text or "", add_special_tokens=False).ids, 7], text


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 50)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts, whole = random_texts(30), Tokenizer.from_file(path)
    coder = tokens.PieceEncoder(path, 7)
    for text in texts:
        assert coder.encode(pa.array([text])).to_pylist() == [[*whole.encode(text, add_special_tokens=False).ids, 7]]


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD + random_texts(30)
    out = f"file://{tmp_path}/tokens"
    token_files.write_token_files(documents(spark, texts), out, path, end_id=2)
    rows = token_files.ids_crc32(token_files.read_token_files(spark, out)).orderBy("start").collect()
    order = [3] + [i for i in range(len(texts)) if i != 3]
    at = 0
    for row, i in zip(rows, order, strict=True):
        ids = np.array(whole.encode(texts[i] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (None if i == 3 else i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    selective = token_files.read_token_files(spark, out).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids#" not in selective.split("ReadSchema")[-1]
    with pytest.raises(ValueError):
        token_files.file_options("other", 1, 1)


def test_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD + random_texts(60)
    rows = packing.pack(documents(spark, texts), path, end_id=1, window=256, with_ids=True).collect()
    by_doc = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 1024
        by_doc[r.doc_id].append(r)
    for i, text in enumerate(texts):
        pieces = sorted(by_doc[None if i == 3 else i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids + [1]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256 and all(r.sequence_length == at for r in some)
    used = sum(r.length for r in rows)
    assert used / (256 * len(sequences)) > 0.9


def test_packing_plan_holds_the_histogram():
    rng = np.random.default_rng(0)
    histogram = np.r_[0, rng.integers(0, 400, 64)]
    found = packing.plan(histogram)
    used = np.zeros_like(histogram)
    for pattern, times in found:
        assert sum(pattern) <= 64 and times > 0
        used += np.bincount(pattern, minlength=65) * times
    assert (used == histogram).all()
    assert sum(t for _, t in found) <= 1.06 * np.ceil((histogram * np.arange(65)).sum() / 64)


def measures(text):
    text = text or ""
    found = WORD.findall(text)
    where = defaultdict(list)
    for i in range(len(found) - 2):
        where[tuple(found[i : i + 3])].append(i)
    covered = {i + j for places in where.values() if len(places) > 1 for i in places for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    texts = ODD + random_texts(20, vocabulary=8) + ["shared line here\n" + t for t in random_texts(80, seed=9)] + [" ".join(f"menu{k}" for k in range(40)) + f"\n{i} " + " ".join(f"own{i}x{k}" for k in range(25)) for i in range(40)]
    rows = {r.doc_id: r for r in quality.quality(documents(spark, texts), min_docs=5, max_share=0.01).collect()}
    source = [["b", "a", None, "c"][i % 4] for i in range(len(texts))]
    fold = lambda line: re.sub("[0-9]", "0", " ".join(WORD.findall(line)).lower())
    held = Counter((s, line) for s, t in set(zip(source, texts, strict=True)) for line in {fold(x) for x in (t or "").split("\n")})
    for i, text in enumerate(texts):
        r = rows[None if i == 3 else i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == measures(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if held[source[i], fold(x)] > 5)
        assert r.boilerplate_words == lost
        assert r.kept == (not r.base_failed and r.n_words - lost >= 50 and 2 * (r.n_words - lost) >= r.n_words)
    assert any(r.boilerplate_words > 0 for r in rows.values())
    assert any(not r.base_failed and not r.kept for r in rows.values()) and any(r.kept for r in rows.values())


def test_near_duplicates(spark):
    rng, base = random.Random(2), random_texts(25, seed=5, vocabulary=400)
    texts = list(ODD)
    for text in base:
        parts = text.split(" ")
        for _ in range(rng.randint(1, 5)):
            copy = list(parts)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "other", "zzz"])
            texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(documents(spark, texts), shingle=2).collect()}
    sets = {}
    for i, text in enumerate(texts):
        found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(zip(found, found[1:])) if len(found) > 1 else frozenset([tuple(found)]) if found else frozenset()
    ids = [i for i in sets if i != 3]
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(links) > 20
    want = roots(ids, links)
    assert {i: (len(sets[i]), want[i]) for i in ids} == {i: got[i] for i in ids}
    assert got[None] == (len(sets[3]), None)


def test_quality_removes_frequent_lines(spark):
    texts = [None, ""] + [f"Shared  line {i % 10}\n{t}\n\n" for i, t in enumerate(random_texts(60, seed=9))]
    docs = storage.materialize(documents(spark, texts).withColumn("row", F.monotonically_increasing_id()), "rows")
    verdicts = quality.judged(docs, min_words=20, min_docs=5, max_share=0.01, row="row")
    got = {r.doc_id: r for r in quality.cleaned(docs, verdicts, "row").collect()}
    kept = {r.doc_id for r in verdicts.where("kept").collect()}
    source = [["b", "a", None, "c"][i % 4] for i in range(len(texts))]
    fold = lambda line: re.sub("[0-9]", "0", " ".join(WORD.findall(line)).lower())
    held = Counter((s, line) for s, t in zip(source, texts, strict=True) for line in {fold(x) for x in (t or "").split("\n")})
    assert set(got) == kept and len(kept) > 20
    for i, text in enumerate(texts):
        if (r := got.get(None if i == 3 else i)) is not None:
            want = "\n".join(x for x in text.split("\n") if not fold(x) or held[source[i], fold(x)] <= 5)
            assert (r.text, r.n_chars, r.bucket) == (want, len(want), 1)
            assert len(want) < len(text)


def family(rng, n, length, changed, again):
    """Word lists of a template with ``changed`` words replaced, each with a partner of ``again`` more replaced."""
    template, fresh, found = [f"w{i}" for i in range(length)], iter(range(10**9)), []
    for _ in range(n):
        one = list(template)
        for i in rng.sample(range(length), changed):
            one[i] = f"x{next(fresh)}"
        two = list(one)
        for i in rng.sample(range(length), again):
            two[i] = f"y{next(fresh)}"
        found += [one, two]
    return found


def test_near_duplicates_of_a_template(spark):
    """Hundreds of documents of one template are under 0.8 to one another, and each has a near copy."""
    texts = [" ".join(x) for x in family(random.Random(6), 400, 201, 8, 7)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs, shingle=2).collect()}
    sets = [frozenset(zip(w, w[1:])) for w in map(str.split, texts)]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(range(len(sets)), links)
    assert len(set(want.values())) > 300
    assert got == want


def test_near_duplicates_of_a_hot_region(spark, monkeypatch):
    """The near copies of one template are found as well where its regions are dealt by deeper keys."""
    monkeypatch.setattr(neighbours, "SAMPLED", 1)
    texts = [" ".join(x) for x in family(random.Random(8), 150, 201, 8, 7)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs, shingle=2).collect()}
    assert len(set(got.values())) > 100
    assert all(got[i] == got[i + 1] for i in range(0, 300, 2))


def test_line_dedup(spark):
    line = "the quick brown fox jumps over the lazy dog near the river bank at dawn every day while nobody else is looking from the old stone bridge"
    texts = [f"{line}\nfirst one stays", f"alone\n{line}", f"{line.replace('dawn', 'dusk')}\n\nend", None, "", "  The Quick\nfirst one stays", f"{line} and quite a lot more words that make it another line because they go on and on until the end\nalone"]
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[0].text == texts[0] and rows[0].n_removed == 0
    assert rows[1].text == "alone" and rows[1].n_removed == 1
    assert rows[2].text == "\nend" and rows[2].n_lines == 3
    assert rows[None].text is None and rows[4].text == ""
    assert rows[5].text == "  The Quick" and rows[6].text == texts[6].split("\n")[0]
    assert rows[1].n_chars == 5 and rows[1].bucket == 1 and set(docs.columns) <= set(rows[0].asDict())


def test_line_dedup_of_a_template(spark):
    """Hundreds of lines of one template are under 0.8 to one another, and each has a near copy."""
    rng, fresh = random.Random(7), iter(range(0x4E00, 0x9000))
    template, lines = [rng.choice("abcdefgh ") for _ in range(500)], []
    template[0] = template[-1] = "z"
    for _ in range(400):
        one = list(template)
        for i in rng.sample(range(4, 500, 10), 5):
            one[i] = chr(next(fresh))
        two = list(one)
        for i in rng.sample(range(4, 500, 10), 5):
            two[i] = chr(next(fresh))
        lines += ["".join(one), "".join(two)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    removed = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.n_removed}
    sets = [frozenset(x[i : i + 8] for i in range(len(x) - 7)) for x in lines]
    links = [(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(range(len(sets)), links)
    assert len(set(want.values())) > 150
    assert removed == {i for i, first in want.items() if i != first}


def test_bounds_lose_no_line(spark):
    """Pairs of 0.8 and more pass the bound, most others don't; all wanted lines pass the bounded table."""
    rng, lines = random.Random(3), []
    for _ in range(60):
        one = [rng.choice("abcdefghij klmé") for _ in range(rng.choice([5, 60, 300]))]
        lines += ["".join(one), "".join(one[: len(one) * 9 // 10]), "".join(rng.choice("xyz ") if rng.random() < 0.02 else c for c in one)]
    sets = [frozenset(x[i : i + 8] for i in range(max(1, len(x) - 7))) for x in lines]
    a, b = np.triu_indices(len(lines), 1)
    similar = np.array([100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]) for x, y in zip(a, b)])
    kept = line_dedup.possible_pairs([x.encode() for x in lines], a, b, 80)
    assert similar.sum() > 60 and not (similar & ~kept).any() and kept.sum() < len(a) // 10
    ids = spark.range(20000)
    passed = {r.id for r in line_dedup.may_be_in(ids, ids.where("id % 100 = 0")).collect()}
    assert set(range(0, 20000, 100)) <= passed and len(passed) < 2000


def test_arrow_batches_are_bounded_in_bytes(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    storage.bounded_batches(spark)
    sizes = spark.range(4000, numPartitions=1).selectExpr("repeat('some text ', 1000) AS text").mapInArrow(lambda some: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in some), "n long").collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) < 2 * storage.BATCH
    spark.conf.set(key, "1000000")
    storage.bounded_batches(spark)
    assert spark.conf.get(key).startswith("1000000")
    spark.conf.unset(key)
    released = []
    monkeypatch.setattr(wordhash.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: released.append(1)})())
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    assert list(wordhash.released(lambda some: some)(iter(batches))) == batches and len(released) == 3


def test_language_id(spark):
    rng = random.Random(3)
    words = {"en": ["the", "and", "with", "thing", "which"], "fr": ["le", "les", "étaient", "avec", "eaux"], "de": ["der", "und", "nicht", "schön", "über"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(5, 60))), k) for i, k in enumerate(rng.choice(list(words)) for _ in range(300))]
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "123 !", "fr"), (902, "日本", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs.where("lang is not null").where(~langid.held_out(docs.doc_id)))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == k for i, _, k in rows if zlib.crc32(str(i).encode()) % 3 == 1]) > 0.97
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0
    assert got[902].lang_pred in words and got[902].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.fit(docs.where("false")) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_language_sample_is_bounded_and_no_label_is_lost(spark):
    same = spark.createDataFrame([(7, f"one two {i}", "en") for i in range(3000)] + [(None, f"un deux {i}", "fr") for i in range(50)], "doc_id long, text string, lang string").repartition(5)
    taken = []
    real = langid.cluster
    langid.cluster = lambda rows, k, steps=15: taken.append(len(rows)) or real(rows, k, steps)
    try:
        langid.fit(same, per_language=400)
    finally:
        langid.cluster = real
    assert 300 <= taken[0] <= 400 and taken[1] == 50
    many = spark.createDataFrame([(i, chr(0x4E00 + 5 * i) * 5 + "common words", f"l{i:03d}") for i in range(230) for _ in range(2)], "doc_id long, text string, lang string")
    model = langid.fit(many)
    assert len(set(model.languages)) == 230
    got = langid.identify(many, model).collect()
    assert all(r.lang_pred == f"l{r.doc_id:03d}" for r in got)
    with pytest.raises(ValueError):
        langid.fit(many, max_languages=229)


def grams(text):
    """Weighed features of a text, one n-gram after the other."""
    points, mask = [ord(c) if c.isalpha() else 0 for c in text.lower() + "\n"], (1 << 64) - 1  # a text ends with a gap
    out = Counter()
    for n in (1, 2, 3):
        for at in range(len(points) - n + 1):
            if any(points[at : at + n]):
                code = 0
                for k, p in enumerate(points[at : at + n]):
                    code = ((code + k + 1) * 0x9E3779B97F4A7C15 + p * 0xC2B2AE3D27D4EB4F) & mask
                out[((code ^ code >> 29) * 0xBF58476D1CE4E5B9 & mask) >> 52] += 1
    return out


def test_languages_against_brute_force(spark):
    rng = random.Random(9)
    words = {"en": ["the", "and", "with", "thing"], "fr": ["le", "les", "étaient", "avec"], "x": ["le", "the", "zz"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randint(3, 9))), k) for i, k in enumerate(rng.choice(list(words)) for _ in range(90))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    counts = [grams(t) for _, t, _ in rows]
    seen = Counter(f for c in counts for f in c)
    idf = {f: np.log((1 + len(rows)) / (1 + n)) + 1 for f, n in seen.items()}
    vectors = np.zeros((len(rows), langid.FEATURES))
    for v, c in zip(vectors, counts, strict=True):
        for f, n in c.items():
            v[f] = np.log1p(n) * idf[f]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    languages = np.array([k for _, _, k in rows])
    for k in words:
        own = vectors[languages == k]
        centres = model.centroids[[j for j, x in enumerate(model.languages) if x == k]]
        near = (own @ centres.T).argmax(axis=1)
        for j, centre in enumerate(centres):
            mean = own[near == j].sum(axis=0)
            assert centre @ mean / np.linalg.norm(mean) > 0.999  # k-means may stop a step before it stands still
    cosines = vectors @ model.centroids.T
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for i, row in enumerate(cosines):
        assert got[i].score == pytest.approx(row.max(), abs=1e-4)
        assert got[i].lang_pred == model.languages[int(row.argmax())] or np.sort(row)[-1] - np.sort(row)[-2] < 1e-5


def targets(sizes, weights=(3, 1, 2), share=1.5):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (left - sum(fixed.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > 2 * sizes[s]]
        if not over:
            return fixed | {s: w[s] * level for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark):
    texts = ODD + random_texts(300, seed=8)
    docs = documents(spark, texts)
    rows = mixing.mix(docs).collect()
    sizes, taken, said = Counter(), Counter(), {}
    source = {None if i == 3 else i: ["b", "a", None, "c"][i % 4] for i in range(len(texts))}
    for r in rows:
        i = 3 if r.doc_id is None else r.doc_id
        assert r.size == len(WORD.findall(texts[i] or "")) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        said[source[r.doc_id]] = (r.source_size, r.target)
    want = targets(sizes)
    for s in sizes:
        assert said[s][0] == sizes[s] and said[s][1] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 2
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in again) == sorted((r.doc_id or -1, r.taken) for r in rows)


def test_licenses(spark):
    texts = ["Released under the MIT License.", "CC-BY 4.0 licence, cc by; CC BY", "All Rights Reserved. all rights\nreserved", "This work is licensed under the GNU General Public License, version 3.", None, "", "thunder", "SPDX-License-Identifier: Apache-2.0", "hicc by all rights reservedx"]
    rows = {r.doc_id: r for r in licenses.summary(licenses.scan(documents(spark, ["pad", *texts[:2], "none", *texts[2:]]))).collect()}
    assert (rows[1].labels, rows[1].n_base, rows[1].first_word) == ("mit", 0, None)
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].base_labels) == (3, 0, 7, "cc-by") and "cc-by-4.0" in rows[2].labels
    assert (rows[4].n_base, rows[4].n_words, rows[4].base_labels) == (2, 6, "reserved")
    assert rows[5].base_labels == "gpl" and "gpl-3.0" in rows[5].labels.split(",") and rows[5].first_word == 7
    for i in (6, 7):
        assert (rows[i].n_words, rows[i].n_base, rows[i].labels, rows[i].score) == (0, 0, "", 0.0)
    assert rows[8].labels == "" and rows[9].labels == "apache-2.0" and rows[9].score == 1.0 and rows[10].n_base == 0


@pytest.mark.parametrize("run", [
    lambda d: licenses.summary(licenses.scan(d)), lambda d: mixing.mix(d), lambda d: near_dups.near_duplicates(d), line_dedup.dedup_lines, quality.quality,
    lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json"), 1), lambda d: langid.identify(d, None),
])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
