"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

Texts are cut into stretches of bytes; two recurrent layers read each stretch from either end, a
softmax labels every byte, and a text's probabilities are the mean of those of its bytes. Training
is backpropagation through time on stretches drawn from a bounded sample of labelled rows
(`per_lang` rows of each language, by hashed id). Scoring is one pass over the documents, all bytes
of each, with a model of a few thousand numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_residue

HIDDEN = 6
STRETCH = 64
PER_LANG = 300
STEPS = 300
#: Stretches that are read side by side.
WIDE = 1024
UNKNOWN = "und"


class Layer:
    """One direction. given: (3H, 256) input weights by byte; back: (3H, H); bias: (H, 1) inside the reset.

    Gates are clipped to 0..1 and candidates to -1..1: piecewise linear forms of the usual curves,
    several times cheaper over all bytes of a corpus.
    """

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.given = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.given[: 2 * hidden] = 0.5 + self.given[: 2 * hidden] / 4
        self.back = rng.normal(0, 0.7 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)
        self.back[: 2 * hidden] /= 4
        self.bias = np.zeros((hidden, 1), np.float32)

    def read(self, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """data: (steps, stretches) bytes -> states (steps, H, stretches); keep collects what backward needs."""
        n, wide = self.back.shape[1], data.shape[1]
        h = np.zeros((n, wide), np.float32)
        out = np.empty((len(data), n, wide), np.float32)
        x, u, gates, inner, new = (np.empty((k * n, wide), np.float32) for k in (3, 3, 2, 1, 1))
        for t, row in enumerate(data):
            if keep is not None:
                gates, inner, new = (np.empty_like(a) for a in (gates, inner, new))
            np.take(self.given, row, axis=1, out=x, mode="clip")
            np.matmul(self.back, h, out=u)
            np.add(x[: 2 * n], u[: 2 * n], out=gates)
            np.clip(gates, 0, 1, out=gates)
            np.add(u[2 * n :], self.bias, out=inner)
            np.multiply(gates[n:], inner, out=new)
            new += x[2 * n :]
            np.clip(new, -1, 1, out=new)
            if keep is not None:
                keep.append((h, gates, inner, new))
            h = np.subtract(h, new, out=out[t])
            h *= gates[:n]
            h += new
        return out

    def backward(self, data: np.ndarray, keep: list, grad: np.ndarray) -> list[np.ndarray]:
        n = self.back.shape[1]
        d_given, d_back, d_bias = np.zeros((256, 3 * n), np.float32), np.zeros_like(self.back), np.zeros_like(self.bias)
        carry = np.zeros_like(grad[0])
        for t in range(len(data) - 1, -1, -1):
            h, gates, inner, new = keep[t]
            z, r = gates[:n], gates[n:]
            dh = grad[t] + carry
            d_new = dh * (1 - z) * (np.abs(new) < 1)
            d_gate = np.concatenate([dh * (h - new), d_new * inner]) * ((gates > 0) & (gates < 1))
            d_u = np.concatenate([d_gate, d_new * r])
            np.add.at(d_given, data[t], np.concatenate([d_gate, d_new]).T)
            d_back += d_u @ h.T
            d_bias += d_u[2 * n :].sum(1, keepdims=True)
            carry = dh * z + self.back.T @ d_u
        return [d_given.T, d_back, d_bias]


class Model:
    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs, self.ahead, self.behind = langs, Layer(rng, hidden), Layer(rng, hidden)
        self.out = rng.normal(0, 0.3, (len(langs), 2 * hidden)).astype(np.float32)
        self.out_bias = np.zeros((len(langs), 1), np.float32)

    def positions(self, data: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities (steps, langs, stretches), states of both directions)."""
        a = self.ahead.read(data, keep and keep[0])
        b = self.behind.read(data[::-1], keep and keep[1])[::-1]
        n = a.shape[1]
        logits = self.out[:, :n] @ a
        logits += self.out[:, n:] @ b
        logits += self.out_bias
        np.clip(logits, -30, 30, out=logits)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits, np.concatenate([a, b], axis=1) if keep else a

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.given, self.ahead.back, self.ahead.bias, self.behind.given, self.behind.back, self.behind.bias, self.out, self.out_bias]

    def step(self, data: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients."""
        keep: tuple[list, list] = ([], [])
        p, states = self.positions(data, keep)
        at = np.arange(len(lang))
        own = p[:, lang, at]
        d = p.copy()
        d[:, lang, at] -= 1
        d /= data.size
        d_out = np.einsum("tcb,thb->ch", d, states, optimize=True)
        d_states = self.out.T @ d
        n = d_states.shape[1] // 2
        ahead = self.ahead.backward(data, keep[0], d_states[:, :n])
        behind = self.behind.backward(data[::-1], keep[1], d_states[::-1, n:])
        return float(-np.log(own + 1e-9).mean()), [*ahead, *behind, d_out, d.sum((0, 2))[:, None]]

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of the bytes of each text; zeros for an empty text."""
        number = [-(-len(t) // STRETCH) for t in texts]
        data = np.frombuffer(b"".join(t.ljust(n * STRETCH, b" ") for t, n in zip(texts, number)), np.uint8).reshape(-1, STRETCH)
        owner = np.repeat(np.arange(len(texts)), number)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        k = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) if len(owner) else owner
        inside = np.clip(size[owner] - k * STRETCH, 0, STRETCH)
        total = np.zeros((len(texts), len(self.langs)))
        for at in range(0, len(data), WIDE):
            rows = data[at : at + WIDE]
            p, _ = self.positions(np.ascontiguousarray(rows.T).astype(np.intp))
            short = inside[at : at + WIDE]
            if (short < STRETCH).any():
                p *= (np.arange(STRETCH)[:, None] < short)[:, None, :]
            sums = p.sum(axis=0).T
            np.add.at(total, owner[at : at + WIDE], sums)
        return total / np.maximum(1, size)[:, None]


def fit(texts: list[bytes], langs: list[str], *, steps: int = STEPS, batch: int = 192, seed: int = 3) -> Model | None:
    """Stretches are drawn evenly from the languages, from all of each text. None without texts."""
    rows = [(t, lang) for t, lang in zip(texts, langs) if t.strip()]
    names = sorted({lang for _, lang in rows})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    model = Model(names, seed=seed)
    pools = []
    for name in names:
        own = [t.ljust(STRETCH, b" ") for t, lang in rows if lang == name]
        data = np.frombuffer(b"".join(own), np.uint8)
        ends = np.cumsum([len(t) for t in own])
        starts = np.concatenate([np.arange(e - len(t), e - STRETCH + 1, 8) for t, e in zip(own, ends)])
        pools.append((data, starts))
    lang = np.arange(batch) % len(names)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in model.parameters()]
    for step in range(1, steps + 1):
        cut = [pools[c][0][s : s + STRETCH] for c in lang for s in (rng.choice(pools[c][1]),)]
        _, grads = model.step(np.stack(cut, axis=1).astype(np.intp), lang)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * (1 - 0.9 * step / steps)
        for p, g, (m, v) in zip(model.parameters(), grads, moments):
            g = g * min(1.0, 1.0 / (size + 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def sample(docs: DataFrame, train, per_lang: int) -> tuple[list[bytes], list[str]]:
    """Texts and languages of up to per_lang training rows of each language, by hashed id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where("lang is not null and text is not null")
    rows = rows.where(train(F.col("doc_id")))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = rows.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang).select("doc_id", "lang")
    chosen = F.broadcast(few)  # per_lang rows of each language at most
    got = rows.join(chosen, ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"]).orderBy("lang", "doc_id").collect()
    return [r["text"].encode("utf-8", "surrogatepass").lower() for r in got], [r["lang"] for r in got]


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                texts = [(t or "").encode("utf-8", "surrogatepass").lower() if ok else b"" for t, ok in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                p = model.texts(texts) if model else np.zeros((len(texts), 1))
                best, names = p.argmax(axis=1), model.langs if model else [UNKNOWN]
                lang = [names[k] if t else UNKNOWN for k, t in zip(best.tolist(), texts)]
                score = np.where([bool(t) for t in texts], p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def language(docs: DataFrame, *, per_lang: int = PER_LANG, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of docs.

    Ids whose crc32 modulo 4 is 2 are not learnt from. A text that is null or has no letter gets
    `und` with score 0, as do all where nothing can be learnt. Repeated rows get the same prediction. An
    empty table gives an empty result; other columns are ignored.
    """
    held = lambda i: id_residue(i, 4) == 2
    model = fit(*sample(docs, lambda i: ~held(i), per_lang), **options)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held(F.col("doc_id")).alias("held_out"), F.col("text"), letters.alias("letters"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
