"""Scores of documents by a log-bilinear language model over word classes, and by smoothed word counts.

A token is a word (A-Z lowered) or the end of a text. Its class is itself, if it is the end or one of ``OWN`` most
frequent words of the training texts, else its last two bytes, hashed into ``ENDINGS`` classes, so unknown words have
classes too. P(token) = P(class | two classes before) * P(word | class). The second factor is the smoothed share of
the word's count in its class, an unknown word counting as one more word. The first is the neural model: matrices, one a
position, take the vectors of the classes before to a prediction, whose products with all classes' target vectors, plus
biases, are exponents. It is trained by noise-contrastive estimation, with noise from the class counts, on all training
tokens: in each round every task trains a copy on its share, and the copies' mean, weighed by tokens, goes on. Scores
are normalised: each distinct context of a batch meets all classes in a matrix product.

Words are counted over all training texts. Counts of up to ``FREQUENT`` words, those over a count that a histogram of
counts gives, travel with the tasks; tokens of all other words, known or not, join the table of counts. Words are named by 64-bit hashes.
Texts are read twice, once to count and once to note their classes; rounds and scores read classes, two bytes a token.

Null texts are empty: the end is their only token. A null id counts as an empty one for holding out. Repeated rows are
scored (and learned from) each. Without training rows all counts are zero and the model is uniform. Empty tables give
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.llm.storage import materialize
from seamark.llm.wordhash import chunks, mix, words

OWN, ENDINGS = 384, 127
#: The end's class is 0; the start of a text stands before it as a class that is never predicted.
CLASSES = 1 + OWN + ENDINGS
START, CONTEXT = CLASSES, 2
FREQUENT = 1 << 18
#: Steps of the histogram of counts, an eighth of a power of two.
STEPS = 8
WIDTH, NOISE, MINIBATCH, ROUNDS, RATE = 32, 32, 2048, 3, 0.1
#: Where each class's vector stands among all their components.
PLACES = np.arange((CLASSES + 1) * WIDTH).reshape(CLASSES + 1, WIDTH)
#: Tokens handled at once in a task.
SLICE = 1 << 20
#: Parameters are summed as integers of this scale, so that their mean doesn't depend on the order; so many tokens weigh one.
SCALE, WEIGHT = 1 << 20, 1 << 14


def ending_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each word by its last two bytes."""
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[ends - 2], 0).astype(np.uint64)
    return (1 + OWN + mix(last * np.uint64(256) + before) % np.uint64(ENDINGS)).astype(np.int16)


@dataclass
class Vocabulary:
    """Frequent words by hash, in order, with their counts and classes; total and number of the words of each class; N and V."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_total: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int
    texts: int


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash), ending (its class) and n of all words of a column text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").to_pylist()
            hashes, classes = [np.empty(0, np.uint64)], [np.empty(0, np.int16)]
            held = 0
            for low, high in [*chunks(column, 1 << 20), (0, 0)]:
                if low < high:
                    w = words(column[low:high], lower=True)
                    hashes.append(w.hashes)
                    classes.append(ending_classes(w.data, w.starts, w.ends))
                    held += len(w.hashes)
                if held and (low == high or held >= 4 * SLICE):
                    every = np.concatenate(hashes)
                    kinds, first, n = np.unique(every, return_index=True, return_counts=True)
                    ending = np.concatenate(classes)[first]
                    yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(ending), pa.array(n)], names=["word", "ending", "n"])
                    hashes, classes, held = [], [], 0

    found = texts.select("text").mapInArrow(count, "word long, ending short, n long")
    return found.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, texts: int, frequent: int = FREQUENT) -> tuple[Vocabulary, DataFrame]:
    """The part that travels with tasks, and the counts of the words that aren't in it (word, n)."""
    step = F.floor(F.log2("n") * STEPS).cast("int")
    histogram = sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect())  # a few hundred rows at most
    least, held = None, 0
    for row in reversed(histogram):
        held += row["words"]
        if held > frequent:
            break
        least = row["step"]
    often = (step >= least) if least is not None else F.lit(False)
    table = counts.where(often).select("word", "ending", "n").toArrow()  # ``frequent`` rows at most
    names, ending, n = (table[c].to_numpy() for c in ("word", "ending", "n"))
    order = np.argsort(names.view(np.uint64))
    names, classes, n = names[order].view(np.uint64), ending[order].astype(np.int16), n[order].astype(np.int64)
    own = np.lexsort((names, -n))[:OWN]
    classes[own] = 1 + np.arange(len(own))
    total, number = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    rest = counts.where(~often).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()  # a row for each ending
    for row in rest:
        total[row["ending"]], number[row["ending"]] = row["n"], row["words"]
    np.add.at(total, classes, n)
    np.add.at(number, classes, 1)
    total[0], number[0] = texts, int(texts > 0)
    distinct = sum(r["words"] for r in histogram) + int(texts > 0)
    tokens = sum(r["n"] for r in histogram) + texts
    return Vocabulary(names, n, classes, total, number, tokens, distinct, texts), counts.where(~often).select("word", "n")


ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, classes binary, rare array<struct<word: bigint, n: bigint>>"


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Per row: its tokens' classes as 16-bit numbers, sums over tokens of frequent words, and the other words with their numbers.

    base sums log10(count + 1) of known frequent tokens less the denominators of all; within does so for P(word | class).
    """
    log_count = np.log10(known.counts + 1.0)
    log_class = np.log10(known.class_total + known.class_words + 1.0)
    log_class[: 1 + OWN] = 0  # classes of one word
    log_all = np.log10(known.tokens + known.distinct + 1.0)
    end_log = np.log10(known.texts + 1.0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text").to_pylist()
            for low, high in chunks(column, 1 << 20):
                w, size = words(column[low:high], lower=True), high - low
                doc = np.repeat(np.arange(size), np.diff(w.first))
                classes = ending_classes(w.data, w.starts, w.ends)
                if len(known.words):
                    at = np.minimum(np.searchsorted(known.words, w.hashes), len(known.words) - 1)
                    often = known.words[at] == w.hashes
                else:
                    at, often = np.zeros(len(doc), np.int64), np.zeros(len(doc), bool)
                classes[often] = known.classes[at[often]]
                logs = np.zeros(len(doc))
                logs[often] = log_count[at[often]]
                sums = lambda x, doc=doc, size=size: np.bincount(doc, x, size)
                n_words = np.diff(w.first)
                base = sums(logs) + end_log - (n_words + 1) * log_all
                within = sums(np.where(classes > OWN, logs, 0) - log_class[classes])
                seen = sums(often).astype(np.int64) + int(known.texts > 0)
                # the end of each text comes after its words
                flat = np.zeros(len(doc) + size, "<i2")
                flat[np.arange(len(doc)) + doc] = classes
                bounds = np.concatenate([[0], np.cumsum(n_words + 1)])
                lists = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer((2 * bounds).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
                rare = np.stack([doc[~often].astype(np.uint64), w.hashes[~often]], axis=1)
                order = np.lexsort((rare[:, 1], rare[:, 0]))
                rare = rare[order]
                new = np.flatnonzero(np.any(rare[1:] != rare[:-1], axis=1)) + 1 if len(rare) else np.empty(0, np.int64)
                begins = np.concatenate([[0], new]).astype(np.int64) if len(rare) else new
                pairs = pa.StructArray.from_arrays([pa.array(rare[begins, 1].view(np.int64)), pa.array(np.diff(begins, append=len(rare)))], ["word", "n"])
                cuts = np.searchsorted(rare[begins, 0], np.arange(size + 1).astype(np.uint64)).astype(np.int32)
                some = [batch.column(c).slice(low, size) for c in ("row", "doc_id", "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*some, pa.array(n_words + 1), pa.array(seen), pa.array(base), pa.array(within), lists, pa.ListArray.from_arrays(pa.array(cuts), pairs)],
                    names=[*(c for c in ("row", "doc_id", "held_out")), "n_tokens", "n_known", "base", "within", "classes", "rare"],
                )

    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(encode, ENCODED)


@dataclass
class Model:
    """Context vectors (CLASSES + 1 of them), a matrix for each position, target vectors and biases; and Adagrad's sums of squared slopes."""

    parts: list[np.ndarray]
    squares: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        self.squares = self.squares or [np.full(p.shape, 1e-4, np.float32) for p in self.parts]

    def pack(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in [*self.parts, *self.squares]]).astype(np.float64)

    def unpack(self, values: np.ndarray) -> Model:
        shaped = [x.reshape(p.shape).astype(np.float32) for p, x in zip([*self.parts, *self.squares], np.split(values, np.cumsum([p.size for p in [*self.parts, *self.squares]])[:-1]), strict=True)]
        return Model(shaped[: len(self.parts)], shaped[len(self.parts) :])

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        vectors, matrices = self.parts[0], self.parts[1]
        return sum(vectors[contexts[:, j]] @ matrices[j] for j in range(CONTEXT))

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised, of all classes after each context."""
        scores = self.predicted(contexts) @ self.parts[2].T + self.parts[3]
        top = scores.max(axis=1, keepdims=True)
        return scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))


def new_model(noise: np.ndarray, seed: int = 12) -> Model:
    """Small random vectors; biases are the logarithms of the noise."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (0.1 * rng.standard_normal(shape)).astype(np.float32)
    matrices = np.stack([np.eye(WIDTH, dtype=np.float32) / (j + 1) for j in range(CONTEXT)])
    return Model([draw(CLASSES + 1, WIDTH), matrices, draw(CLASSES, WIDTH), np.log(noise).astype(np.float32)])


def summed_rows(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows that have the same number, by number."""
    places = PLACES.take(at, axis=0)
    return np.bincount(places.ravel(), rows.ravel(), size * WIDTH).reshape(size, WIDTH).astype(np.float32)


def train(model: Model, contexts: np.ndarray, targets: np.ndarray, noise: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of noise-contrastive estimation over the tokens, in random order; a minibatch shares its noise.

    Matrices meet the classes' vectors, of which there are fewer than tokens; so slopes are summed by class before they meet matrices.
    """
    vectors, matrices, target_vectors, biases = model.parts
    upto, log_noise = np.cumsum(noise), np.log(NOISE * noise).astype(np.float32)
    order = rng.permutation(len(targets))
    contexts, targets = contexts[order].astype(np.int64), targets[order].astype(np.int64)
    for low in range(0, len(order), MINIBATCH):
        before, true = contexts[low : low + MINIBATCH], targets[low : low + MINIBATCH]
        false = np.minimum(np.searchsorted(upto, rng.random(NOISE) * upto[-1], "right"), CLASSES - 1)
        seen = vectors @ matrices
        guess = sum(seen[j].take(before[:, j], axis=0) for j in range(CONTEXT))
        true_vectors, false_vectors = target_vectors.take(true, axis=0), target_vectors.take(false, axis=0)
        good = np.einsum("ij,ij->i", guess, true_vectors) + (biases - log_noise).take(true)
        bad = guess @ false_vectors.T + (biases - log_noise).take(false)
        # slopes of -log sigmoid(good) - sum log(1 - sigmoid(bad)), as a mean over the tokens
        share = np.float32(1 / len(true))
        with np.errstate(over="ignore"):
            to_good = -share / (1 + np.exp(good))
            to_bad = share / (1 + np.exp(-bad))
        to_guess = to_bad @ false_vectors
        to_guess += to_good[:, None] * true_vectors
        to_targets = summed_rows(true, to_good[:, None] * guess, CLASSES)
        np.add.at(to_targets, false, to_bad.T @ guess)
        to_biases = np.bincount(true, to_good, CLASSES) + np.bincount(false, to_bad.sum(axis=0), CLASSES)
        by_class = np.stack([summed_rows(before[:, j], to_guess, CLASSES + 1) for j in range(CONTEXT)])
        slopes = ((by_class @ matrices.transpose(0, 2, 1)).sum(axis=0), vectors.T @ by_class, to_targets, to_biases.astype(np.float32))
        for p, s, slope in zip(model.parts, model.squares, slopes, strict=True):
            s += slope * slope
            p -= RATE * slope / np.sqrt(s)


def contexts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of a batch of classes: the classes before each, its class, and the row of each."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    flat = np.frombuffer(b"".join(x.as_buffer() for x in column), "<i2")
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    before = np.full((len(flat), CONTEXT), START, np.int16)
    for j in range(CONTEXT):
        inside = at > j
        before[inside, j] = flat[np.flatnonzero(inside) - j - 1]
    return before, flat, np.repeat(np.arange(len(lengths)), lengths)


def mean_model(copies: DataFrame) -> DataFrame:
    """The weighed sum of copies (part, total, weight), in two steps, each task holding one sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight, part = None, 0, 0
        for batch in batches:
            for value, own, part in zip(batch.column("total"), batch.column("weight").to_pylist(), batch.column("part").to_pylist(), strict=True):
                one = np.frombuffer(value.as_buffer(), np.int64)
                total, weight = one.copy() if total is None else total + one, weight + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.tobytes()], pa.binary()), pa.array([weight])], names=["part", "total", "weight"])

    schema = "part long, total binary, weight long"
    some = copies.withColumn("part", F.pmod("part", F.lit(64))).groupBy("part").applyInArrow(add, schema)
    return some.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInArrow(add, schema)


def trained(tokens: DataFrame, noise: np.ndarray, rounds: int = ROUNDS) -> Model:
    """A model of a column classes; each task trains a copy, and the copies' mean begins the next round."""
    model = new_model(noise)
    for number in range(rounds):
        now = model

        def run(batches: Iterator[pa.RecordBatch], now: Model = now, number: int = number) -> Iterator[pa.RecordBatch]:
            own, weight, part = Model([p.copy() for p in now.parts], [s.copy() for s in now.squares]), 0, 0
            for batch in batches:
                before, true, _ = contexts_of(batch.column("classes"))
                for low in range(0, len(true), SLICE):
                    rng = np.random.default_rng([number, weight])
                    train(own, before[low : low + SLICE], true[low : low + SLICE], noise, rng)
                    weight += len(true[low : low + SLICE])
                    part = part or int(true[:64].astype(np.int64).sum())
            if weight:
                share = max(1, weight // WEIGHT)
                total = np.rint(own.pack() * SCALE).astype(np.int64) * share
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.tobytes()], pa.binary()), pa.array([share])], names=["part", "total", "weight"])

        copies = tokens.select("classes").mapInArrow(run, "part long, total binary, weight long")
        found = materialize(mean_model(copies), "model").collect()  # one row of the parameters' size
        if found:
            model = model.unpack(np.frombuffer(found[0]["total"], np.int64) / (SCALE * found[0]["weight"]))
    return model


def class_scores(tokens: DataFrame, model: Model, block: int = 4096) -> DataFrame:
    """Per row: the sum of log10 P(class | classes before)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, true, row = contexts_of(batch.column("classes"))
            total = np.zeros(len(batch))
            for low in range(0, len(true), SLICE):
                part = slice(low, low + SLICE)
                code = before[part, 0].astype(np.int32) * (CLASSES + 1) + before[part, 1]
                kinds, own = np.unique(code, return_inverse=True)
                order = np.argsort(own, kind="stable")
                found = np.empty(len(code))
                edges = np.searchsorted(own[order], np.arange(0, len(kinds) + block, block))
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    some = kinds[k * block : (k + 1) * block]
                    logs = model.log_probabilities(np.stack([some // (CLASSES + 1), some % (CLASSES + 1)], axis=1))
                    which = order[a:b]
                    found[which] = logs[own[which] - k * block, true[part][which]]
                total += np.bincount(row[part], found, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(total / np.log(10))], names=["row", "neural"])

    return tokens.select("row", "classes").mapInArrow(run, "row long, neural double")


def lm_scores(docs: DataFrame, held: Column, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from rows that ``held`` is not true of.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    learned = rows.where(~F.col("held_out"))
    counts = materialize(word_counts(learned), "word-counts")
    known, others = vocabulary(counts, learned.count(), frequent)
    tokens = materialize(encoded(rows, known), "classes")
    noise = (known.class_total + 1.0) / (known.class_total + 1.0).sum()
    model = trained(tokens.where(~F.col("held_out")), noise, rounds if known.tokens else 0)
    if not known.tokens:
        model.parts[2][:] = 0
    rare = tokens.select("row", F.explode("rare").alias("of")).select("row", "of.word", F.col("of.n").alias("times")).join(others, "word")
    sums = rare.groupBy("row").agg(F.sum("times").alias("seen"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"))
    told = tokens.drop("classes", "rare").join(class_scores(tokens, model), "row").join(sums, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return told.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("neural") + F.col("within") + logs).alias("score"),
    )
