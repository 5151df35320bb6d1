"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the average of the vectors of its n-grams (3 to 6 bytes, with marks at its ends) and its
own; a bag is the average over the places of a short window (a word repeated there counts once, and the
places that it leaves, or that a short text lacks, count as zero), so a few toxic words stand out in
a long text; a softmax over the two classes scores the bag. A text's logit weighs its windows' logits by
their own softmax, so the worst window decides and every word of the text is read. The label is
the text's: training lets the weights find the window. Misspelt or compounded words share n-grams.

Training reads a bounded sample of labelled rows (`per_class` rows of each class, by hashed id, whole
texts). Scoring is one pass over the documents with a table of one number per n-gram bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import id_residue, slices

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4, 5, 6)
SPAN, HOP = 6, 3
PER_CLASS = 1000
EPOCHS = 100
#: Distinct words whose scores a task keeps.
CACHE = 100_000


def subwords(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word index) of every n-gram of the words, and of the words themselves."""
    marked = [b"<" + w + b">" for w in words]
    data = np.frombuffer(b"".join(marked), np.uint8)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(data))  # bytes to the word's end
    table, ids, owners = wordhash.odd(41, 256)[data], [], []
    value = np.zeros(len(data), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        if len(data) < n:
            break
        value = value[: len(data) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + table[n - 1 :]
        if n in NGRAMS:
            inside = left[: len(value)] >= n
            ids.append((wordhash.mix(value[inside] + np.uint64(n)) & np.uint64(buckets - 1)).astype(np.int32))
            owners.append(owner[: len(value)][inside])
    whole = wordhash.digests(marked)
    ids.append((wordhash.mix(whole) & np.uint64(buckets - 1)).astype(np.int32))
    owners.append(np.arange(len(words), dtype=np.int32))
    return np.concatenate(ids), np.concatenate(owners)


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end word, text) of each window; a text without words has none."""
    number = np.where(counts > 0, np.maximum(0, -(-(counts - SPAN) // HOP)) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), number)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    base = (np.cumsum(counts) - counts)[owner]
    return base + k * HOP, np.minimum(base + k * HOP + SPAN, base + counts[owner]), owner


def _fresh(word: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 for each word that its text has not had in the SPAN - 1 words before, else 0."""
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(word, kind="stable")
    w, t = word[order], text[order]
    again = np.zeros(len(word), bool)
    again[order[1:]] = (w[1:] == w[:-1]) & (t[1:] == t[:-1]) & (np.diff(order) < SPAN)
    return (~again).astype(float)


def _pool(z: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows' weights and texts' logits; 0 for texts without windows."""
    if not len(z):
        return z, np.zeros(n)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    top = np.maximum.reduceat(z, first)
    weight = np.exp(z - np.repeat(top, np.diff(np.append(first, len(z)))))
    weight /= np.add.reduceat(weight, first)[np.cumsum(np.diff(owner, prepend=owner[0]) > 0)]
    out = np.zeros(n)
    out[owner[first]] = np.add.reduceat(weight * z, first)
    return weight, out


class Model:
    """One number per bucket (its vector times the difference of the classes' weights), and a bias."""

    def __init__(self, table: np.ndarray, bias: float, constant: float | None = None):
        self.table, self.bias, self.constant = table, bias, constant

    def words(self, words: list[bytes]) -> np.ndarray:
        ids, owner = subwords(words, len(self.table))
        return np.bincount(owner, self.table[ids], len(words)) / np.maximum(1, np.bincount(owner, minlength=len(words)))

    def texts(self, word: np.ndarray, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Texts' scores; word: each place's word, scores: each word's number."""
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        start, end, owner = _windows(counts)
        total = np.concatenate([[0.0], np.cumsum(scores[word] * _fresh(word, counts))])
        z = (total[end] - total[start]) / SPAN + self.bias
        logits = _pool(z, owner, len(counts))[1]
        logits[counts == 0] = self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def fit(texts: list[str | None], labels: list[int], *, epochs: int = EPOCHS, buckets: int = BUCKETS, dim: int = DIM, rate: float = 1.0, seed: int = 5) -> Model:
    """Gradient steps on all parameters at once: n-gram vectors and softmax weights. With one class only, or no
    rows, every text scores that class's label, or 0."""
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1), 0.0, float(y[0]) if len(y) else 0.0)
    index: dict[bytes, int] = {}
    # A text at a time: the driver never holds the words of all of them.
    places = [np.fromiter((index.setdefault(w, len(index)) for w in tokens(t)), np.int32) for t in texts]
    word, counts = np.concatenate(places), np.fromiter(map(len, places), np.int64, len(places))
    ids, owner = subwords(list(index), buckets)
    order = np.argsort(owner, kind="stable")
    ids, owner = ids[order], owner[order]
    seen, ids = np.unique(ids, return_inverse=True)  # only buckets that occur are trained
    ids = ids.astype(np.int32)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.bincount(owner, minlength=len(index))
    by_bucket = np.argsort(ids, kind="stable").astype(np.int32)
    count = len(index)
    del order, places, index
    bucket_first = np.flatnonzero(np.diff(ids[by_bucket], prepend=-1))
    start, end, text = _windows(counts)
    fresh = _fresh(word, counts)
    rng = np.random.default_rng(seed)
    vectors, softmax, bias = rng.normal(0, 0.1, (len(seen), dim)), rng.normal(0, 0.3, dim), -1.0
    speed = [np.zeros_like(vectors), np.zeros(dim), 0.0]
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for step in range(epochs):
        # All is linear up to the pooling, so averages of vectors are taken after the product with the
        # softmax weights, and gradients are spread before it.
        scores = np.add.reduceat((vectors @ softmax)[ids], first) / size
        total = np.concatenate([[0.0], np.cumsum(scores[word] * fresh)])
        weight, logit = _pool((total[end] - total[start]) / SPAN + bias, text, len(y))
        error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * balance / len(y)
        g = weight * error[text]
        spread = np.bincount(start, g / SPAN, len(word) + 1) - np.bincount(end, g / SPAN, len(word) + 1)
        per_word = np.bincount(word, np.cumsum(spread)[:-1] * fresh, count) / size
        per_bucket = np.add.reduceat(per_word[owner][by_bucket], bucket_first)
        grads = per_bucket[:, None] * softmax[None, :], per_bucket @ vectors, g.sum()
        # One scale for each kind of parameter: a bucket moves in proportion to its gradient, so chance
        # differences of rare n-grams stay small beside those that mark many texts.
        for k, grad in enumerate(grads):
            speed[k] = 0.9 * speed[k] + 0.1 * grad
        slow = rate * (1 - step / epochs)
        vectors -= slow * speed[0] / (np.abs(speed[0]).max() + 1e-30)
        softmax -= 0.1 * slow * speed[1] / (np.abs(speed[1]).max() + 1e-30)
        bias -= 0.1 * slow * speed[2] / (abs(speed[2]) + 1e-3 * slow)
    table = np.zeros(buckets)
    table[seen] = vectors @ softmax
    return Model(table, bias)


def sample(docs: DataFrame, labels: DataFrame, train, per_class: int) -> tuple[list, list]:
    """Texts and labels of up to per_class training rows of each class, by hashed id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(train(F.col("doc_id")))
    few = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # 2 * per_class rows at most
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return [r["text"] for r in got], [r["toxic"] for r in got]


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[bytes, int] = {}
        known = np.zeros(0)

        class Cache(dict):
            def __missing__(self, word: bytes) -> int:
                self[word] = n = len(self)
                new.append(word)
                return n

        index, new = Cache(), []
        for big in batches:
            for b in slices(big, 2):
                if len(index) > CACHE:
                    index, known = Cache(), np.zeros(0)
                split = [tokens(t) for t in b.column(2).to_pylist()]
                counts = np.fromiter(map(len, split), np.int64, len(split))
                new.clear()
                places = np.fromiter(map(index.__getitem__, (w for ws in split for w in ws)), np.int64, int(counts.sum()))
                if new:
                    known = np.concatenate([known, model.words(new)])
                score = model.texts(places, known, counts)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs.

    Labels are learnt from ids whose crc32 modulo 5 is not 0; ids with several labels count as toxic
    if one says so, null labels are no labels. Null and empty texts get the score of no words.
    Repeated rows are scored alike. Other columns are ignored; an empty table gives an empty result.
    """
    held = lambda i: id_residue(i, 5) == 0
    model = fit(*sample(docs, labels, lambda i: ~held(i), per_class), **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held(F.col("doc_id")).alias("held_out"), F.col("text"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")


def apply_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    model = fit(*sample(docs, labels, lambda i: id_residue(i, 5) != 0, options.pop("per_class", PER_CLASS)), **options)
    score = _score(model)

    @F.arrow_udf("int")
    def predicted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Only texts go to Python and only labels come back; rows stay in the JVM.
        for t in texts:
            blank = pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.bool_())
            asked = pa.RecordBatch.from_arrays([*blank, t], ["doc_id", "held_out", "text"])
            yield pa.concat_arrays([pa.array([], pa.int32()), *(x.column(3) for x in score(iter([asked])))])

    return docs.where(predicted(F.col("text").cast("string")) == 0)
