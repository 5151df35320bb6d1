"""Prediction by partial matching over bytes, trained on the corpus by Spark jobs.

A text is its lower-cased words and one end. A word is coded as its bytes and a space, the end as a
line feed, so every text has one code and the code lengths are those of a proper model. A symbol's context is
the bytes before it in the whole text, previous words and spaces included; only the text's start is padded by
zero bytes. Escapes follow method C (as many escapes as distinct symbols seen), and the symbols of the longer
context are excluded from the shorter ones; below order 0 all symbols left are equally likely.

Where the data goes:
* counts: (context, symbol) and token counts of a batch of documents, one row each per batch;
* trie: (context, symbol) counts over all batches, dealt by the context's last two bytes. All longer and
  shorter contexts that a code needs then lie in one group, whose memory follows its distinct rows; the
  last byte and no context are a table of 65,792 counts that is sent along;
* code lengths go back to the batches by (batch, context, symbol) rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, id_residue, materialise

#: Context bytes; with the symbol, up to 6 fit the 64 bits of a row's key.
ORDER = 5
SYMBOLS = 256
END = b"\n"
#: Text bytes of a batch. What a batch sends is its distinct contexts, which grow slower than its text.
BATCH_BYTES = 32 << 20
#: Text bytes that numpy works on at a time: about 80 bytes of arrays for each. A longer text is a slice of its own.
SLICE_BYTES = 1 << 18
#: Counts of slices that a task holds before it sums them up.
HELD_ROWS = 1 << 18
#: Words whose counts are looked up at a time.
ASKED_WORDS = 1 << 18


def _tokens(text: str) -> list[bytes]:
    """Words of lower-cased text as bytes. bytes.split() splits at exactly 09-0D and 20."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _code(words: list[bytes], order: int) -> bytes:
    """A text's bytes as they are coded, after the pad of its start."""
    return bytes(order) + b"".join([w + b" " for w in words]) + END


def _windows(codes: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, symbol) of each coded byte of each text, and the text's index."""
    data = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, codes), np.int64, len(codes))
    packed = data.copy()
    for k in range(1, order + 1):
        packed[k:] |= data[:-k] << (8 * k)
    inside = np.ones(len(data), bool)
    inside[((np.cumsum(lengths) - lengths)[:, None] + np.arange(order)).ravel()] = False
    return packed[inside], np.repeat(np.arange(len(codes)), lengths - order)


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of n of each."""
    by = np.argsort(keys, kind="stable")
    keys, n = keys[by], n[by]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def _text_slices(texts: pa.ChunkedArray, order: int) -> Iterator[tuple[int, list[list[bytes]], list[bytes]]]:
    """First row, words and codes of consecutive texts of about SLICE_BYTES; a longer text is a slice of its own."""
    first, words, codes, held = 0, [], [], 0
    for k, text in enumerate(texts):
        words.append(_tokens(text.as_py()))
        codes.append(_code(words[-1], order))
        held += len(codes[-1])
        if held >= SLICE_BYTES:
            yield first, words, codes
            first, words, codes, held = k + 1, [], [], 0
    if words:
        yield first, words, codes


def _release() -> None:
    """Give freed Arrow memory back; a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()


class _Summed:
    """Counts by key that come slice by slice; kept as arrays and summed up whenever HELD_ROWS more are there."""

    def __init__(self, add):
        self.add, self.parts, self.rows = add, [], 0

    def take(self, part, rows: int) -> None:
        self.parts.append(part)
        self.rows += rows
        if self.rows > HELD_ROWS:
            self.parts, self.rows = [self.total()], 0
            _release()

    def total(self):
        return self.add(self.parts) if len(self.parts) > 1 else self.parts[0]


def _added_words(parts: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("n", "sum")])
    return summed.rename_columns({"n_sum": "n"})


def _added_grams(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _sums(*(np.concatenate(x) for x in zip(*parts)))


def _batch_counts(order: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # A null mark holds out nothing.
        held = np.array([bool(h) for h in table.column("held_out").to_pylist()], bool)
        tokens, found = _Summed(_added_words), _Summed(_added_grams)
        for first, words, codes in _text_slices(table.column("text"), order):
            own = held[first : first + len(codes)]
            seen = Counter({END: int((~own).sum())})
            for w, h in zip(words, own):
                seen.update(dict.fromkeys(w, 0) if h else w)
            tokens.take(pa.table({"token": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())}), len(seen))
            grams, owner = _windows(codes, order)
            # The mark in the lowest bit: one sort counts learnt and merely asked ones.
            marked, n = np.unique((grams << 1) | own[owner], return_counts=True)
            part = _sums(marked >> 1, np.where(marked & 1, 0, n))
            found.take(part, len(part[0]))
        (grams, n), words = found.total(), tokens.total()
        _release()
        none = {"token": pa.nulls(len(grams), pa.binary()), "gram": pa.nulls(words.num_rows, pa.int64())}
        return pa.concat_tables([
            pa.table({"batch": np.full(words.num_rows, key[0].as_py(), np.int32), "token": words["token"], "gram": none["gram"], "n": words["n"]}),
            pa.table({"batch": np.full(len(grams), key[0].as_py(), np.int32), "token": none["token"], "gram": grams, "n": n.astype(np.int64)}),
        ])

    return run


class _Level:
    """What was seen after the contexts of one length: rows (context, symbol) in order, with counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n
        self.contexts, starts = np.unique(keys >> 8, return_index=True)
        self.kinds = np.diff(np.r_[starts, len(keys)])
        self.total = np.add.reduceat(n, starts) if len(starts) else n
        self.starts = starts

    @staticmethod
    def _at(known: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(asked), np.int64)
        at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        return np.where(known[at] == asked, values[at], 0)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return self._at(self.keys, self.n, keys)

    def of(self, values: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        return self._at(self.contexts, values, contexts)


def code_lengths(gram: np.ndarray, n: np.ndarray, lower: list[np.ndarray], depth: int, order: int) -> np.ndarray:
    """log10 probability of each distinct (context, symbol), in memory that follows the rows; n = 0: only asked for.
    lower: counts for contexts of 0, 1, ... bytes below the group's depth.

    The symbols seen after a context were all seen after its shorter ones. So what a level excludes is
    exactly what the level above has seen, and is summed once per context.
    """
    keep = n > 0
    levels = [_Level(np.flatnonzero(c), c[c > 0].astype(np.int64)) for c in lower[:depth]]
    for k in range(depth, order + 1):
        levels.append(_Level(*_sums(gram[keep] & ((1 << 8 * (k + 1)) - 1), n[keep])))
    out = np.zeros(len(gram))
    top, context = levels[order], gram[keep] >> 8
    out[keep] = np.log10(n[keep] / (top.of(top.total, context) + top.of(top.kinds, context)))
    asked = gram[~keep]
    log, done = np.zeros(len(asked)), np.zeros(len(asked), bool)
    for k in range(order, -1, -1):
        level, context = levels[k], (asked >> 8) & ((1 << 8 * k) - 1)
        total, kinds = level.of(level.total, context), level.of(level.kinds, context)
        if k < order and len(levels[k + 1].keys):
            above = levels[k + 1]
            outer = (asked >> 8) & ((1 << 8 * (k + 1)) - 1)
            spent = np.add.reduceat(level.count(above.keys & ((1 << 8 * (k + 1)) - 1)), above.starts)
            total, kinds = total - above.of(spent, outer), kinds - above.of(above.kinds, outer)
        own = level.count(asked & ((1 << 8 * (k + 1)) - 1))
        hit, escape = ~done & (own > 0), ~done & (own == 0) & (kinds > 0)
        log[hit] += np.log10(own[hit] / (total[hit] + kinds[hit]))
        log[escape] += np.log10(kinds[escape] / (total[escape] + kinds[escape]))
        done |= hit
    log[~done] -= math.log10(max(1, SYMBOLS - len(levels[0].keys)))
    out[~keep] = log
    return out


def _tail_codes(lower: list[np.ndarray], depth: int, order: int):
    def run(table: pa.Table) -> pa.Table:
        gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
        return pa.table({"gram": gram, "log": code_lengths(gram, n, lower, depth, order)})

    return run


class _Words:
    """Counts and base scores of texts' words, looked up ASKED_WORDS at a time in a batch's vocabulary."""

    def __init__(self, tokens: pa.Table, total: int, distinct: int):
        self.names, self.c = tokens.column("token").combine_chunks(), tokens.column("c").to_numpy()
        self.base = np.log10((self.c + 1) / (total + 1 * (distinct + 1)))
        self.asked, self.held = [], 0
        self.n, self.hits, self.bases = [], [], []

    def ask(self, words: list[list[bytes]]) -> None:
        self.asked += [[*w, END] for w in words]
        self.held += sum(map(len, words))
        if self.held >= ASKED_WORDS:
            self.answer()

    def answer(self) -> None:
        texts, sizes = len(self.asked), np.fromiter(map(len, self.asked), np.int64, len(self.asked))
        at = pc.index_in(pa.array([x for w in self.asked for x in w], pa.binary()), value_set=self.names).to_numpy()
        owner = np.repeat(np.arange(texts), sizes)
        self.n.append(sizes)
        self.hits.append(np.bincount(owner[self.c[at] > 0], minlength=texts))
        self.bases.append(np.bincount(owner, weights=self.base[at], minlength=texts))
        self.asked, self.held = [], 0
        _release()


def _text_scores(total: int, distinct: int, order: int):
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        tokens = _Words(known.filter(known.column("token").is_valid()).select(["token", "c"]), total, distinct)
        codes = known.filter(known.column("gram").is_valid()).select(["gram", "log"])
        gram, log = codes.column("gram").to_numpy(), codes.column("log").to_numpy()
        by = np.argsort(gram)
        gram, log = gram[by], log[by]
        scores = []
        for _, words, coded in _text_slices(docs.column("text"), order):
            tokens.ask(words)
            grams, owner = _windows(coded, order)
            # Asked in order: neighbours of a sorted array lie in one another's cache lines.
            asked, each = np.unique(grams, return_inverse=True)
            scores.append(np.bincount(owner, weights=log[np.searchsorted(gram, asked)][each], minlength=len(coded)))
        tokens.answer()
        joined = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": joined(tokens.n, np.int64),
            "n_known": joined(tokens.hits, np.int64), "train_tokens": np.full(docs.num_rows, total, np.int64),
            "base_score": joined(tokens.bases, float), "score": joined(scores, float),
        })

    return run


def ppm_score(docs: DataFrame, *, order: int = ORDER, held_out=None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    held_out: a Column; its rows are scored but not learnt from (default: crc32 of the id modulo 7 is
    2; a null mark holds out nothing). A null text is empty and costs its end. Repeated rows are learnt and
    scored each. With no training rows every symbol costs log10 256. Null ids are kept as they are. Other
    columns are ignored; an empty table gives an empty result.
    """
    if order < 1 or order > 6:
        raise ValueError("order is 1 to 6: context and symbol are one LONG")
    held = (id_residue(F.col("doc_id"), 7) == 2) if held_out is None else held_out
    rows, _ = batched(docs, batch_bytes, F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"))
    counts = materialise(rows.groupBy("batch").applyInArrow(_batch_counts(order), "batch int, token binary, gram long, n long"), "ppm-counts")
    words, grams = counts.where("token is not null").select("batch", "token", "n"), counts.where("gram is not null").select("batch", "gram", "n")
    vocabulary = materialise(words.groupBy("token").agg(F.sum("n").alias("c")), "ppm-vocabulary")
    sums = vocabulary.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    total, distinct = int(sums[0] or 0), int(sums[1] or 0)
    trie = materialise(grams.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-trie")
    depth = min(2, order - 1)
    lower = []
    if depth:
        cells = np.zeros(SYMBOLS**depth)
        for r in trie.groupBy(F.col("gram").bitwiseAND(F.lit(SYMBOLS**depth - 1)).alias("g")).agg(F.sum("n").alias("n")).toLocalIterator():
            cells[r["g"]] = r["n"]
        lower = [cells.reshape(-1, SYMBOLS).sum(0), cells][2 - depth :]
    tail = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("tail")
    codes = trie.withColumn("tail", tail).groupBy("tail").applyInArrow(_tail_codes(lower, depth, order), "gram long, log double")
    none = {t: F.lit(None).cast(t) for t in ("binary", "long", "double")}
    by_gram = grams.join(codes, "gram").select("batch", none["binary"].alias("token"), none["long"].alias("c"), "gram", "log")
    by_token = words.join(vocabulary, "token").select("batch", "token", "c", none["long"].alias("gram"), none["double"].alias("log"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("batch").cogroup(by_gram.union(by_token).groupBy("batch")).applyInArrow(_text_scores(total, distinct, order), schema)


class Trie:
    """The same model in memory: for adaptive code lengths of single texts, and to test against."""

    def __init__(self, order: int = ORDER):
        self.order, self.seen = order, {}

    def contexts(self, text: str) -> Iterator[tuple[bytes, int]]:
        coded = _code(_tokens(text), self.order)
        for i in range(self.order, len(coded)):
            yield coded[i - self.order : i], coded[i]

    def learn(self, context: bytes, symbol: int, times: int = 1) -> None:
        for k in range(self.order + 1):
            self.seen.setdefault(context[k:], Counter())[symbol] += times

    def symbol_log(self, context: bytes, symbol: int) -> float:
        log, excluded = 0.0, set()
        for k in range(self.order + 1):
            own = {s: n for s, n in self.seen.get(context[k:], {}).items() if s not in excluded}
            total = sum(own.values()) + len(own)
            if symbol in own:
                return log + math.log10(own[symbol] / total)
            if own:
                log += math.log10(len(own) / total)
            excluded |= own.keys()
        return log - math.log10(SYMBOLS - len(excluded))


def adaptive_score(docs: DataFrame, *, order: int = ORDER) -> DataFrame:
    """doc_id, n_tokens and the adaptive score of each row: a text is coded by its own bytes so far alone.

    A null text is empty and costs its end; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, logs = [], []
            for text in b["text"]:
                trie, log = Trie(order), 0.0
                for context, symbol in trie.contexts(text or ""):
                    log += trie.symbol_log(context, symbol)
                    trie.learn(context, symbol)
                n.append(len(_tokens(text or "")) + 1)
                logs.append(log)
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "score": logs})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, n_tokens long, score double")
