"""Packing documents into windows: non-negative least squares over the length histogram.

1. Each text is tokenised once; its ids fill whole windows, and a rest shorter than a window stays.
2. The histogram of the rests (at most window - 1 counts) goes to the driver, which enumerates the
   combinations of up to three lengths that fill a window exactly, or are a power of two on their
   own, solves their repeat counts against the histogram by non-negative least squares, rounds them
   down and fits them greedily to what is left of the histogram. Memory there depends on the window,
   not on the input.
3. Every rest gets a rank among the rests of its length (a two-level count: ranges of a hashed key,
   then inside a range). The plan says which ranks go to which slot of which combination: an interval
   table of a few thousand rows at most, which is broadcast.
4. Residual rests are packed greedily, longest lengths first, each cut where a window is full. Their
   places follow from length and rank. What the last window lacks is split into powers of two, so
   nothing is padded.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WINDOW = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"
#: Solver sweeps, and combinations that enter the active set in a round.
ROUNDS, ENTER, SWEEPS = 12, 256, 40


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str):
    """text -> ids. The ranks are read from the tokenizer's file; tiktoken applies the same merges
    several times faster. Texts that contain a special token go to tokenizers itself."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    if path != public_tokenizers.path("byte_bpe_50k.json"):
        return lambda text: np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    return encode


def _tokenise(path: str, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, row, full = encoder(path), TaskContext.get().partitionId(), 0, 0
        for big in batches:
            for at in range(0, big.num_rows, 512):
                b = big.slice(at, 512)
                uid, tokens, first, rest, crc, crcs, ids = [], [], [], [], [], [], []
                for text in b.column(1).to_pylist():
                    # A surrogate can't be in Arrow text, so what is read here can be encoded.
                    all_ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                    whole, left = divmod(len(all_ids), window)
                    uid.append((part << 40) + row)
                    tokens.append(len(all_ids))
                    first.append(((part + 1) << 40) + full)
                    crcs.append([zlib.crc32(all_ids[k * window : (k + 1) * window]) for k in range(whole)])
                    rest.append(left)
                    end = all_ids[whole * window :].tobytes()
                    crc.append(zlib.crc32(end))
                    ids.append(end)
                    row, full = row + 1, full + whole
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid, pa.int64()), b.column(0).cast(pa.int64()), pa.array(tokens, pa.int64()), pa.array(first, pa.int64()), pa.array(rest, pa.int32()), pa.array(crc, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(ids, pa.binary())],
                    ["uid", "doc_id", "doc_tokens", "first_full", "rest", "crc", "crcs", "ids"],
                )

    return run


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of lengths that occur, with a + b + c = window. No length is
    alone: what these leave fills windows of the residual stream, and only its end is shorter."""
    here = np.flatnonzero(histogram[: window])
    here = here[here > 0]
    present = np.zeros(window + 1, bool)
    present[here] = True
    pairs = here[present[window - here] & (2 * here >= window)]
    found = [np.stack([pairs, window - pairs, 0 * pairs], 1)]
    for c in here[3 * here <= window]:
        b = here[(here >= c) & (2 * here <= window - c)]
        b = b[present[window - c - b]]
        found.append(np.stack([window - c - b, b, 0 * b + c], 1))
    return np.concatenate(found)


def solve(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(combinations, repeat counts): non-negative least squares, rounded so that no length is used
    more often than it occurs.

    Combinations enter an active set by the gradient of the squared error, the steepest first; the
    active set is solved by coordinate descent, where every step is exact and never negative.
    """
    combos = combinations(histogram, window)
    h = histogram.astype(float).copy()
    h[0] = 0.0
    if not len(combos):
        return combos, np.zeros(0, np.int64)

    def gain(residual: np.ndarray) -> np.ndarray:
        return residual[combos].sum(axis=1)  # residual[0] is 0: empty slots count nothing

    x, residual, active = np.zeros(len(combos)), h.copy(), np.zeros(len(combos), bool)
    for _ in range(ROUNDS):
        g = np.where(active, -np.inf, gain(residual))
        new = np.argsort(-g, kind="stable")[:ENTER]
        new = new[g[new] > 1e-6]
        if not len(new):
            break
        active[new] = True
        members = [(j, *np.unique(combos[j][combos[j] > 0], return_counts=True)) for j in np.flatnonzero(active).tolist()]
        for _ in range(SWEEPS):
            moved = 0.0
            for j, lengths, times in members:
                step = max(-x[j], float(residual[lengths] @ times) / float(times @ times))
                if step:
                    x[j] += step
                    residual[lengths] -= step * times
                    moved = max(moved, abs(step))
            if moved < 0.25:
                break
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    counts = np.zeros(len(combos), np.int64)
    by_count, by_parts = np.argsort(-x, kind="stable"), np.argsort((combos > 0).sum(1), kind="stable")
    # The rounded solution, what of it still fits, and then any combination that does, pairs first.
    for order, whole in ((by_count[: (x > 0).sum()], True), (by_count[: (x > 0).sum()], False), (by_parts, False)):
        if order is by_parts:
            order = order[((left[combos[order]] > 0) | (combos[order] == 0)).all(axis=1)]
        for j in order.tolist():
            lengths, times = np.unique(combos[j][combos[j] > 0], return_counts=True)
            n = int((left[lengths] // times).min())
            n = min(n, int(x[j])) if whole else n
            if n > 0:
                counts[j] += n
                left[lengths] -= n * times
    used = counts > 0
    return combos[used], counts[used]


def plan(histogram: np.ndarray, window: int) -> tuple[list[tuple], np.ndarray, np.ndarray, int]:
    """(slots, used, places, sequences): slots (length, first rank, end rank, first sequence, offset);
    used: ranks of each length that slots take; places: where the first residual rest of a length
    begins in the residual stream; sequences: number of those that combinations fill."""
    combos, counts = solve(histogram, window)
    slots, used, sequence = [], np.zeros(window, np.int64), 0
    for combo, n in zip(combos.tolist(), counts.tolist()):
        offset = 0
        for length in (c for c in combo if c):
            slots.append((length, int(used[length]), int(used[length]) + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    residual = (histogram.astype(np.int64) - used) * np.arange(window)
    residual[0] = 0
    places = residual[::-1].cumsum()[::-1] - residual
    return slots, used, places, sequence


def pack(docs: DataFrame, *, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty: its end id alone is packed. Repeated rows are packed each. Other columns are
    ignored; an empty table gives an empty result. tokenizer: path of a tokenizers file that exists
    on every executor.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "uid long, doc_id long, doc_tokens long, first_full long, rest int, crc long, crcs array<long>, ids binary"
    cut = materialise(text.mapInArrow(_tokenise(tokenizer or default_tokenizer(), window, end_id), schema), "tokens")
    histogram, rows = np.zeros(window, np.int64), 0
    for r in cut.groupBy("rest").count().collect():  # at most `window` rows
        histogram[r["rest"]] = r["count"]
        rows += r["count"]
    slots, used, places, sequences = plan(histogram, window)
    spark = docs.sparkSession
    whole = cut.where("size(crcs) > 0").select("doc_id", "doc_tokens", "first_full", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("first_full") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rests = cut.where("rest > 0").select("uid", "doc_id", "doc_tokens", F.col("rest").cast("long").alias("rest"), "crc")
    # Ranks among rests of one length, two levels: ranges of a hashed key, then inside a range.
    ranges = max(1, math.isqrt(rows))
    keyed = rests.withColumn("key", F.xxhash64("uid")).withColumn("range", F.pmod("key", F.lit(ranges)))
    ahead = Window.partitionBy("rest").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("rest", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    ranked = keyed.withColumn("rn", F.row_number().over(Window.partitionBy("rest", "range").orderBy("key", "uid"))).join(offsets, ["rest", "range"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("rn") - 1).drop("key", "range", "rn", "before")
    lengths = [(n, int(used[n]), int(places[n])) for n in range(1, window) if histogram[n]]
    per_length = spark.createDataFrame(lengths or [(0, 0, 0)], "rest long, used long, place long")
    # At most `window` rows, and at most three slots for each combination with a positive count.
    slot_table = spark.createDataFrame(slots or [(0, 0, 0, 0, 0)], "rest long, lo long, hi long, seq long, at long")
    placed = ranked.join(F.broadcast(per_length), "rest")
    combined = placed.where("rank < used").alias("p").join(F.broadcast(slot_table).alias("s"), F.expr("p.rest = s.rest AND p.rank >= s.lo AND p.rank < s.hi"))
    combined = combined.select("p.doc_id", (F.col("doc_tokens") - F.col("p.rest")).alias("start"), F.col("p.rest").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", (F.col("seq") + F.col("rank") - F.col("lo")).alias("sequence_id"), F.col("at").alias("offset"))
    # The residual stream: windows, and powers of two where its end lies.
    total = int(((histogram - used) * np.arange(window))[1:].sum())
    borders, tail, at = [], total % window, total - total % window
    for bit in range(window.bit_length() - 1, -1, -1):
        if tail & (1 << bit):
            borders.append(at)
            at += 1 << bit
    bounds = F.array(*[F.lit(b) for b in [*borders, total]]).cast("array<long>")
    stream = placed.where("rank >= used").withColumn("begin", F.col("place") + (F.col("rank") - F.col("used")) * F.col("rest")).withColumn("end", F.col("begin") + F.col("rest"))
    inner = F.concat(
        F.when(F.floor((F.col("end") - 1) / window) > F.floor(F.col("begin") / window), F.array(F.floor((F.col("end") - 1) / window).cast("long") * window)).otherwise(F.array().cast("array<long>")),
        F.filter(bounds, lambda b: (b > F.col("begin")) & (b < F.col("end"))))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("begin"), inner, F.array("end"))))
    parts = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), lambda i: F.struct(F.element_at("cuts", i).alias("a"), F.element_at("cuts", i + 1).alias("b")))
    split = stream.withColumn("cuts", cuts).withColumn("pieces", F.size("cuts") - 1).withColumn("p", F.explode(parts)).select("*", "p.a", "p.b")
    base = total - total % window
    after = F.filter(bounds, lambda b: b <= F.col("a"))
    in_tail = F.col("a") >= base
    number = F.when(in_tail, F.lit(base // window) + F.size(after) - 1).otherwise(F.floor(F.col("a") / window))
    origin = F.when(in_tail, F.element_at(after, -1)).otherwise(F.floor(F.col("a") / window) * window)
    split = split.select("uid", "doc_id", (F.col("doc_tokens") - F.col("rest") + F.col("a") - F.col("begin")).alias("start"), (F.col("b") - F.col("a")).alias("length"), "crc", "pieces", "doc_tokens", (number + sequences).cast("long").alias("sequence_id"), (F.col("a") - origin).cast("long").alias("offset"), (F.col("a") - F.col("begin")).alias("skip"))
    uncut = split.where("pieces = 1").select("doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    # Only cut rests need their ids again.
    again = split.where("pieces > 1").join(cut.select("uid", "ids"), "uid")
    piece = F.substring("ids", (F.col("skip") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    parted = again.select("doc_id", "start", "length", F.crc32(piece).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    return whole.unionByName(combined).unionByName(uncut).unionByName(parted)
