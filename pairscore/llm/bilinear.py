"""Language-model scores from a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

Counts of all training tokens come first. The most frequent words are units of their own; the other frequent words
share a unit with those of the same power of two in count, and the rest, with all unknown words, is one more unit. A
word's probability is that of its unit, from the neural model, times its share of the unit, from the counts:

* unit u after the units c1 (before it) and c2: softmax over u of (r[c1] A + r[c2] B) . q[u] + b[u];
* word w in u: count(w) / count(u); in the rest (count(w) + 1) / (tokens + distinct words + 1), one part for 'unknown'.

So what the counts gather grows with the corpus, while the network has a fixed size. It is trained without computing the
normaliser, by telling each token from noise drawn from the unit counts. One task trains a first version on a bounded
share of the documents; then every task goes on from it over all its training documents, and the parameters are averaged
by tokens. For scoring, the normalisers of all pairs of units are worked out once by batched matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, hash_ranges, hash_share, lower_ascii, split_words, store, text_bytes
from .prefixes import crc32

#: Words with a unit of their own, and the size of a unit's vectors: the network's size does not depend on the corpus.
OWN_UNITS, DIM = 960, 16
#: Words whose counts every task holds, 18 bytes each; all others are joined.
HEAD_WORDS = 1 << 19
#: Tokens that the first version is trained on (an expected number: documents are drawn by a hash), and tokens it sees
#: over all its passes, of which there are at most MOST_PASSES.
FIRST_TOKENS, FIRST_SEEN, MOST_PASSES = 1 << 20, 3 << 20, 50
#: Tokens a step, and draws of noise that they share: of the first version, and of the pass over all documents.
FIRST_STEP, STEP, RATE = (1024, 64), (4096, 32), 0.1
FLUSH = 1 << 22
#: Hash of the token that ends a document; no word hashes to it but by a collision.
END = np.int64(0x5E4D)


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, lower-cased in A-Z, with an end after each; and each text's first token."""
    data, bounds = text_bytes(column)
    data = lower_ascii(data)
    start, end, first = split_words(data, bounds)
    words = hash_ranges(data, start, end).view(np.int64)
    return np.insert(words, first[1:], END), first + np.arange(len(first))


# ---------------------------------------------------------------------- counts

def count_tokens(docs: DataFrame) -> DataFrame:
    """(hash, c): counts of all tokens of the whole texts."""
    def work(batches):
        held, size = [], 0
        for batch in by_bytes(batches, "text"):
            held.append(tokens(batch.column("text"))[0])
            size += len(held[-1])
            if size > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(np.concatenate(held), return_counts=True)], ["hash", "n"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(np.concatenate(held), return_counts=True)], ["hash", "n"])
    return docs.select("text").mapInArrow(work, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """The counts by hash as a table, and for the frequent words (``c`` of at least ``least``, and the end) as arrays."""
    counts: DataFrame
    total: int
    distinct: int
    least: int
    head: np.ndarray      # sorted hashes
    count: np.ndarray
    unit: np.ndarray      # of each word in head; unit 0 is the rest
    share: np.ndarray     # log10 of each word's share of its unit
    unigram: np.ndarray   # of each unit, from the counts

    @property
    def rest(self) -> int:
        """Tokens and distinct words of the rest, and one for unknown words."""
        return int(self.total - self.count.sum()) + self.distinct - len(self.head) + 1

    def tail(self) -> DataFrame:
        """(hash, c) of the words that are not in ``head``."""
        return self.counts.where((F.col("c") < self.least) & (F.col("hash") != int(END)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Chooses head and units: the words of the highest counts, as far as HEAD_WORDS go; singletons are never among them."""
    sums = counts.agg(F.count("*"), F.sum("c")).first()
    distinct, total = int(sums[0]), int(sums[1] or 0)
    # a histogram of counts by their first four binary digits: under 512 rows, whatever the corpus
    bits = F.length(F.bin("c"))
    step = F.expr("CAST(pow(2, greatest(length(bin(c)) - 4, 0)) AS BIGINT)")
    least, words = 1 << 62, 0
    for bucket in sorted(counts.groupBy((F.col("c") - F.pmod("c", step)).alias("low"), bits.alias("bits"))
                         .agg(F.count("*").alias("n")).collect(), reverse=True):
        words += bucket["n"]
        if words > HEAD_WORDS or bucket["low"] < 2:
            break
        least = bucket["low"]
    part = counts.where((F.col("c") >= least) | (F.col("hash") == int(END))).toArrow()
    head, count = part.column("hash").to_numpy(), part.column("c").to_numpy().astype(np.int64)
    order = np.argsort(head)
    head, count = head[order], count[order]
    by_count = np.lexsort((head, -count))
    own = by_count[: OWN_UNITS]
    if len(head) and not (head[own] == END).any():
        own = np.append(own[: OWN_UNITS - 1], np.flatnonzero(head == END))
    # units: the rest, the powers of two that occur, the words by themselves
    power = np.frexp(count.astype(np.float64))[1]
    power[own] = -1
    groups = np.unique(power[power >= 0])
    unit = (1 + np.searchsorted(groups, power)).astype(np.int16)
    unit[own] = 1 + len(groups) + np.arange(len(own))
    units = 1 + len(groups) + len(own)
    size = np.bincount(unit, weights=count, minlength=units)
    vocab = Vocabulary(counts, total, distinct, int(least), head, count, unit, np.log10(count / np.maximum(size[unit], 1)), size)
    size[0] = vocab.rest
    vocab.unigram = size / size.sum()
    return vocab


def encode(docs: DataFrame, key: str, held_out: Column, vocab: Vocabulary) -> DataFrame:
    """(row, key, held_out, units, base, inside, n_head, rest_hash, rest_n): the units of each text's tokens; the sums over
    its frequent words of log10(count + 1) and of log10 of the share in the unit; and its other words with their numbers."""
    table = docs.sparkSession.sparkContext.broadcast((vocab.head, vocab.unit, np.log10(vocab.count + 1.0), vocab.share))

    def work(batches):
        head, unit_of, base_of, share_of = table.value
        part, seen = TaskContext.get().partitionId(), 0
        for batch in by_bytes(batches, "text"):
            words, first = tokens(batch.column("text"))
            rows = batch.num_rows
            at = np.minimum(np.searchsorted(head, words), max(0, len(head) - 1))
            hit = head[at] == words if len(head) else np.zeros(len(words), bool)
            sums = [np.add.reduceat(np.where(hit, x[at] if len(head) else 0, 0), first[:-1]) for x in (base_of, share_of, np.ones(len(head)))]
            units = np.where(hit, unit_of[at] if len(head) else 0, 0).astype(np.int16)
            other = np.flatnonzero(~hit)
            row = np.searchsorted(first, other, "right") - 1
            order = np.lexsort((words[other], row))
            row, word = row[order], words[other][order]
            lead = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(word, prepend=0) != 0) | (np.arange(len(row)) == 0))
            bounds = pa.array(np.searchsorted(row[lead], np.arange(rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array((np.int64(part) << 40) + seen + np.arange(rows)), batch.column(key), batch.column("held_out"),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(units)), pa.array(sums[0], pa.float64()),
                pa.array(sums[1], pa.float64()), pa.array(sums[2].astype(np.int64)),
                pa.ListArray.from_arrays(bounds, pa.array(word[lead])),
                pa.ListArray.from_arrays(bounds, pa.array(np.diff(np.append(lead, len(row)))))],
                ["row", key, "held_out", "units", "base", "inside", "n_head", "rest_hash", "rest_n"])
            seen += rows
    return docs.select(F.col(key).cast("long").alias(key), held_out.alias("held_out"), "text").mapInArrow(
        work, f"row long, `{key}` long, held_out boolean, units array<short>, base double, inside double, n_head long, "
              "rest_hash array<long>, rest_n array<long>")


# --------------------------------------------------------------------- network

def shapes(units: int) -> list[tuple]:
    """Context vectors (one more for the start of a text), two context matrices, target vectors, biases."""
    return [(units + 1, DIM), (DIM, DIM), (DIM, DIM), (units, DIM), (units,)]


def unpack(flat: np.ndarray, units: int) -> list[np.ndarray]:
    out, at = [], 0
    for shape in shapes(units):
        size = int(np.prod(shape))
        out.append(flat[at: at + size].reshape(shape))
        at += size
    return out


def start_parameters(unigram: np.ndarray) -> np.ndarray:
    """Small vectors and the unit counts as biases: before training the model is the unigram."""
    rng = np.random.default_rng(11)
    parts = [rng.normal(0, 0.1, s) for s in shapes(len(unigram))]
    parts[1] += np.eye(DIM) * 0.5
    parts[2] += np.eye(DIM) * 0.5
    parts[4] = np.log(np.maximum(unigram, 1e-12))
    return np.concatenate([p.ravel() for p in parts])


def contexts(units: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The unit before each token and the one before that, ``start`` where the text has none."""
    c1, c2 = np.empty(len(units), np.int64), np.empty(len(units), np.int64)
    c1[1:], c2[2:] = units[:-1], units[:-2]
    c1[first[:-1]] = start
    c2[first[:-1]] = start
    second = first[:-1] + 1
    c2[second[second < first[1:]]] = start
    return c1, c2


def _scatter(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    flat = (index[:, None] * DIM + np.arange(DIM)).ravel()
    return np.bincount(flat, weights=values.ravel(), minlength=rows * DIM).reshape(rows, DIM)


class Trainer:
    """Adagrad ascent on the noise-contrastive objective, batch by batch."""

    def __init__(self, flat: np.ndarray, squares: np.ndarray | None, unigram: np.ndarray, seed: int, step: tuple[int, int]):
        self.flat, self.units = flat.astype(np.float32), len(unigram)
        self.squares = np.full(len(flat), 1e-8, np.float32) if squares is None else squares.astype(np.float32)
        self.weights = unpack(self.flat, self.units)
        self.cumulated = np.cumsum(unigram)
        self.batch, self.draws = step
        self.log_noise = np.log(np.maximum(unigram, 1e-12) * self.draws).astype(np.float32)
        self.rng, self.seen = np.random.default_rng(seed), 0

    def learn(self, units: np.ndarray, first: np.ndarray) -> None:
        c1, c2 = contexts(units, first, self.units)
        for lo in range(0, len(units), self.batch):
            at = slice(lo, lo + self.batch)
            self._step(units[at].astype(np.int64), c1[at], c2[at])
        self.seen += len(units)

    def _step(self, w, c1, c2) -> None:
        context, a, b, target, bias = self.weights
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(self.draws)), self.units - 1)
        r1, r2 = context[c1], context[c2]
        hidden = r1 @ a + r2 @ b
        qw, qn = target[w], target[noise]
        data = np.einsum("ij,ij->i", hidden, qw) + bias[w] - self.log_noise[w]
        false = hidden @ qn.T + (bias[noise] - self.log_noise[noise])
        up = 1 / (1 + np.exp(np.clip(data, -30, 30)))              # 1 - sigmoid
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = up[:, None] * qw + down @ qn
        grads = [_scatter(c1, back @ a.T, self.units + 1) + _scatter(c2, back @ b.T, self.units + 1), r1.T @ back, r2.T @ back,
                 _scatter(w, up[:, None] * hidden, self.units) + _scatter(noise, down.T @ hidden, self.units),
                 np.bincount(w, weights=up, minlength=self.units) + np.bincount(noise, weights=down.sum(0), minlength=self.units)]
        grad = np.concatenate([g.ravel() for g in grads], dtype=np.float32, casting="same_kind") / np.float32(len(w))
        self.squares += grad * grad
        self.flat += RATE * grad / np.sqrt(self.squares)


def _texts(batches):
    """(units, bounds) of the batches of a column ``units``."""
    for batch in batches:
        column = batch.column("units")
        if len(column):
            bounds = np.asarray(column.offsets).astype(np.int64)
            yield np.asarray(column.values)[bounds[0]: bounds[-1]], bounds - bounds[0]


def fit(encoded: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """The parameters after training on all rows of ``encoded`` (row, units)."""
    unigram = vocab.unigram
    start = start_parameters(unigram)

    def first_version(batches):
        parts = list(_texts(batches))            # FIRST_TOKENS short integers, as expected
        trainer = Trainer(start, None, unigram, 0, FIRST_STEP)
        size = sum(len(units) for units, _ in parts)
        for _ in range(min(MOST_PASSES, -(-FIRST_SEEN // max(1, size)))):
            for units, bounds in parts:
                trainer.learn(units, bounds)
        yield pa.RecordBatch.from_arrays([pa.array([trainer.flat]), pa.array([trainer.squares])], ["flat", "squares"])

    share = min(1.0, FIRST_TOKENS / max(1, vocab.total))
    sample = encoded.where(hash_share("row", share)).select("row", "units").repartition(1).sortWithinPartitions("row").select("units")
    first = sample.mapInArrow(first_version, "flat array<float>, squares array<float>").first()
    if first is None:
        return start
    flat, squares = np.asarray(first["flat"]), np.asarray(first["squares"])

    def go_on(batches):
        trainer = Trainer(flat, squares, unigram, 1 + TaskContext.get().partitionId(), STEP)
        for units, bounds in _texts(batches):
            trainer.learn(units, bounds)
        if trainer.seen:
            yield pa.RecordBatch.from_arrays([pa.array([float(trainer.seen)]), pa.array([trainer.flat])], ["seen", "flat"])

    versions = store(encoded.select("units").mapInArrow(go_on, "seen double, flat array<float>"), "lm-versions")
    mean = (versions.select("seen", F.posexplode("flat").alias("place", "value")).groupBy("place")
            .agg((F.sum(F.col("seen") * F.col("value")) / F.sum("seen")).alias("value")).toArrow())
    out = flat.copy()
    out[mean.column("place").to_numpy()] = mean.column("value").to_numpy()
    return out


def normalisers(spark, flat: np.ndarray, units: int) -> np.ndarray:
    """Log of the sum over all units, for every pair of units before: [unit before, the one before that]."""
    context, a, b, target, bias = unpack(flat, units)
    left, right = context @ a, context @ b

    def work(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for lo in ids:
                score = (left[lo] + right) @ target.T + bias
                top = score.max(1)
                yield pa.RecordBatch.from_arrays([pa.array([int(lo)]), pa.array([top + np.log(np.exp(score - top[:, None]).sum(1))])], ["id", "z"])
    part = spark.range(units + 1).mapInArrow(work, "id long, z array<double>").toArrow()
    out = np.empty((units + 1, units + 1))
    out[part.column("id").to_numpy()] = np.asarray(part.column("z").combine_chunks().flatten()).reshape(units + 1, units + 1)
    return out


def log_probabilities(flat, z, units_before, units_before_that, own, units: int) -> np.ndarray:
    """Natural log of the probability of each unit of ``own`` after its two units."""
    context, a, b, target, bias = unpack(flat, units)
    left, right = context @ a, context @ b
    out = np.empty(len(own))
    for lo in range(0, len(own), 1 << 16):
        at = slice(lo, lo + (1 << 16))
        c1, c2, w = units_before[at], units_before_that[at], own[at]
        out[at] = np.einsum("ij,ij->i", left[c1] + right[c2], target[w]) + bias[w] - z[c1, c2]
    return out


def score(docs: DataFrame, held_out: Column, key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (key, text), from a model
    that learns from the rows where ``held_out`` is not true.

    Tokens are the words between spaces and \\x09-\\x0D, A-Z in lower case, and one end a text. ``n_known`` counts tokens that
    occur in the training rows, ``train_tokens`` all tokens of these, ``base_score`` is the add-one unigram's log10
    probability and ``score`` the model's. Words are told apart by 64-bit hashes.

    A null text is empty: its only token is the end. A null ``held_out`` is false; rows that repeat a key are scored each by
    itself; a null key is a key. Without training rows the base is log10(1) a token and the model gives every token to the
    rest, with probability 1. Other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    docs = docs.select(key, "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    vocab = vocabulary(store(count_tokens(docs.where(~F.col("held_out"))), "lm-counts"))
    encoded = store(encode(docs, key, F.col("held_out"), vocab), "lm-units")
    flat = fit(encoded.where(~F.col("held_out")), vocab)
    units = len(vocab.unigram)
    model = spark.sparkContext.broadcast((flat, normalisers(spark, flat, units)))

    def work(batches):
        flat, z = model.value
        for batch in batches:
            for own, bounds in _texts([batch]):
                c1, c2 = contexts(own, bounds, units)
                logs = log_probabilities(flat, z, c1, c2, own.astype(np.int64), units)
                neural = np.add.reduceat(logs, bounds[:-1]) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("row", key, "held_out", "base", "inside", "n_head")], pa.array(np.diff(bounds)), pa.array(neural)],
                    ["row", key, "held_out", "base", "inside", "n_head", "n_tokens", "neural"])
    scored = encoded.select("row", key, "held_out", "base", "inside", "n_head", "units").mapInArrow(
        work, f"row long, `{key}` long, held_out boolean, base double, inside double, n_head long, n_tokens long, neural double")
    # the words that are not in the head: rare ones get their counts by a join, unknown ones none
    rest = encoded.select("row", F.explode(F.arrays_zip("rest_hash", "rest_n")).alias("r")).select(
        "row", F.col("r.rest_hash").alias("hash"), F.col("r.rest_n").alias("n"))
    rest = rest.join(vocab.tail(), "hash", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rest_base"), F.sum("n").alias("rest_n"),
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("rest_known"))
    nil = lambda c: F.coalesce(c, F.lit(0))
    return scored.join(rest, "row", "left").select(
        key, "held_out", "n_tokens", (F.col("n_head") + nil("rest_known")).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + nil("rest_base") - F.col("n_tokens") * F.lit(float(np.log10(vocab.total + vocab.distinct + 1)))).alias("base_score"),
        (F.col("neural") + F.col("inside") + nil("rest_base") - nil("rest_n") * F.lit(float(np.log10(vocab.rest)))).alias("score"))


def held_out_by_id(key: str = "doc_id") -> Column:
    """One row in seven, by the CRC-32 of the decimal key; a null key is not held out."""
    return F.coalesce(crc32(F.col(key)) % 7 == 2, F.lit(False))
