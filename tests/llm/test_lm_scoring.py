"""Counts and scores against plain Python, the model's probabilities, and odd tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.llm import lm_scoring as lm
from seamark.llm import queries, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row int, classes string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_model(rows, held):
    counts, texts = Counter(), 0
    for doc_id, text in rows:
        if not held(doc_id):
            counts.update(WORD.findall(lowered(text)))
            texts += 1
    total, distinct = sum(counts.values()) + texts, len(counts) + (texts > 0)
    out = []
    for doc_id, text in rows:
        tokens = [counts[w] for w in WORD.findall(lowered(text))] + [texts]
        out.append((doc_id, held(doc_id), len(tokens), sum(c > 0 for c in tokens), total, sum(math.log10((c + 1) / (total + distinct + 1)) for c in tokens)))
    return out


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


TEXTS = [None, "", " \n\t", "The the THE", "É é É", "a", "word" * 5000, "zz yy zz\x0bxx", "one two"] + [f"the sea is {w} and the {w} is sea ." for w in "blue green deep calm wide".split()] * 12


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 3, 0])
def test_counts_and_base_scores(spark, frequent):
    rows = [(None if i == 4 else i, t) for i, t in enumerate(TEXTS)] + [(7, TEXTS[7])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = lm.lm_scores(docs, lm.held_out(F.col("doc_id")), rounds=1, frequent=frequent).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    for have, want in zip(sorted(map(tuple, got), key=key), sorted(base_model(rows, fold), key=key), strict=True):
        assert have[:5] == want[:5]
        assert have[5] == pytest.approx(want[5], rel=1e-9)
        assert have[6] <= 0 and math.isfinite(have[6])


def test_probabilities_add_up_and_scores_are_theirs(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], SCHEMA)
    rows = docs.select(F.col("doc_id").alias("row"), "doc_id", F.lit(False).alias("held_out"), "text")
    counts = lm.word_counts(rows)
    known, _ = lm.vocabulary(counts, rows.count())
    tokens = lm.encoded(rows, known)
    noise = (known.class_total + 1.0) / (known.class_total + 1.0).sum()
    model = lm.trained(tokens, noise, 2)
    logs = model.log_probabilities(np.array([[3, 5], [lm.START, lm.START], [0, 1]]))
    assert np.exp(logs.astype(float)).sum(axis=1) == pytest.approx(1, abs=1e-5)
    # within a class of endings: all its words, and one unknown word
    ending = np.flatnonzero(known.class_words[1 + lm.OWN :])
    own = {int(c) for c in known.classes if c > lm.OWN}
    for c in own | {int(1 + lm.OWN + e) for e in ending[:3]}:
        size = known.class_total[c] + known.class_words[c] + 1.0
        assert ((known.counts[known.classes == c] + 1) / size).sum() + 1 / size == pytest.approx(1)
    scored = {r["row"]: r["neural"] for r in lm.class_scores(tokens, model, block=3).collect()}
    place = dict(zip(known.words.tolist(), known.classes.tolist(), strict=True))
    for i in (3, 7, 12):
        w = wordhash.words([TEXTS[i]], lower=True)
        classes = [place[h] for h in w.hashes.tolist()] + [0]
        padded = [lm.START, lm.START, *classes]
        want = sum(float(model.log_probabilities(np.array([[padded[k + 1], padded[k]]]))[0, c]) for k, c in enumerate(classes)) / math.log(10)
        assert scored[i] == pytest.approx(want, rel=1e-5)


def test_training_lowers_the_loss_of_texts_that_it_has_not_seen(spark):
    rng = np.random.default_rng(2)
    follow = {w: [f"w{rng.integers(40)}" for _ in range(3)] for w in [f"w{i}" for i in range(40)]}
    def text():
        w, out = f"w{rng.integers(40)}", []
        for _ in range(60):
            out.append(w)
            w = follow[w][rng.integers(3)]
        return " ".join(out)
    docs = spark.createDataFrame([(i, text(), 1, "x") for i in range(400)], SCHEMA).repartition(3)
    found = lm.lm_scores(docs, F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert found[1] / found[2] > found[0] / found[2] + 0.3


def test_the_mean_of_copies_is_weighed(spark):
    one, two = np.arange(5, dtype=np.int64), np.full(5, 10, np.int64)
    rows = [(k, (v * w).tobytes(), w) for k, (v, w) in enumerate([(one, 3), (two, 1), (one, 2)] * 30)]
    found = lm.mean_model(spark.createDataFrame(rows, "part long, total binary, weight long").repartition(5)).collect()
    assert len(found) == 1 and found[0]["weight"] == 180
    assert np.frombuffer(found[0]["total"], np.int64).tolist() == (30 * (5 * one + two)).tolist()


def test_no_rows_and_no_training_rows(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], SCHEMA)
    assert lm.lm_scores(docs.limit(0), lm.held_out(F.col("doc_id"))).count() == 0
    found = lm.lm_scores(docs, F.lit(True)).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        assert r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == pytest.approx(0)
        assert r["score"] == pytest.approx(-r["n_tokens"] * math.log10(lm.CLASSES), rel=1e-4)


def test_query(spark, sf_dir):
    got = queries.op12_lm_scoring(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, got.collect()))
    for have, want in zip(found, sorted(base_model(rows, fold)), strict=True):
        assert have[:5] == want[:5] and have[5] == pytest.approx(want[5], rel=1e-9)
    out = [r for r in found if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)
