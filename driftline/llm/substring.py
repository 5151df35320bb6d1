"""Substring dedup: repeated word windows by suffix trees that are partitioned by prefix.

A window of 35 words starts a suffix of its text; it occurs twice where two suffixes go down the
same path to depth 35, so below an internal node at that depth or deeper. Only suffixes that may lie
below such a node are moved, with their words:

1. In each window the smallest hashed run of 12 words is its anchor. Equal windows have equal
   anchors, so a window whose anchor occurs once is no repeat. One row per batch of documents and
   distinct anchor is counted.
2. Suffixes are dealt into groups by a prefix of variable length. Neighbouring windows with one anchor
   are one piece of text, and all their suffixes from the anchor on start with its 12 words: that is the group's
   prefix. Where an anchor has more occurrences than a group should hold, each window is a piece of its own and
   the prefix is all its 35 words. A batch sends a row per distinct piece, with its number of
   occurrences, so a passage in a third of all documents makes a row per batch and window.
3. The suffixes of a group are sorted by ranks at depths 1, 2, 4, ... (each a pair of the ranks before), and the same ranks
   give the common prefix of neighbours in that order: the group's tree, as a suffix array with its longest common
   prefixes. Each piece ends in a word of its own, so no path runs over an end. The ranks come from the words themselves; hashes
   only deal rows out.
4. Where neighbours share `window` words or more they lie below one deep internal node. Nodes with two
   occurrences or more below them go back to the batches as the marks of their pieces; the stretches of
   words that they cover are the repeats.

A piece ends with its last window, so a node whose path is longer than the piece is cut there; the next piece goes on. A prefix with more
rows than a task should hold goes through in parts: what has been found twice needs one row to be known again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import BATCH_BYTES, batched, whole_groups

WINDOW = 35
ANCHOR = 12
#: Occurrences of an anchor up to which its pieces are one group.
GROUP_ROWS = 50_000


def _windows(found: wordhash.Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of whole windows, first words of their anchors, and hashes of words and of anchor runs."""
    hashed = wordhash.hashes(found.known)[found.number] if len(found.number) else np.zeros(0, np.uint64)
    valid, runs = wordhash.inside(found.per_text, window), wordhash.runs(hashed, anchor, seed=5)
    if not len(valid):
        return valid, valid, hashed, runs
    view = np.lib.stride_tricks.sliding_window_view(runs, window - anchor + 1)
    place = np.concatenate([view[i : i + 65536].argmin(axis=1) for i in range(0, len(view), 65536)])
    return valid, valid + place[valid], hashed, runs


def _batch(key: tuple[pa.Scalar, ...], rows: int) -> pa.Array:
    return pa.array(np.full(rows, key[0].as_py(), np.int32))


def _anchors(window: int, anchor: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, place, _, runs = _windows(wordhash.words(table.column("text")), window, anchor)
        found, n = np.unique(runs[np.unique(place)], return_counts=True)
        return pa.table({"batch": _batch(key, len(found)), "anchor": found.view(np.int64), "n": n.astype(np.int64)})

    return run


def _repeated(limit: int):
    """Rows of anchors that occur twice or more in all, and whether they are more than a group should hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for table in whole_groups(batches, "anchor", most=max(2, limit + 1)):
            anchor = table.column("anchor").to_numpy()
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            total = np.add.reduceat(table.column("n").to_numpy(), starts)
            if anchor[0] == before:  # in parts: the first of them was over the limit by itself
                total[0] += max(2, limit + 1)
            before = anchor[-1]
            total = np.repeat(total, np.diff(np.r_[starts, len(anchor)]))
            found = table.select(["batch", "anchor"]).append_column("large", pa.array(total > limit))
            yield from found.filter(pa.array(total > 1)).combine_chunks().to_batches()

    return run


class _Pieces:
    """Pieces of a batch for the given anchors, the distinct ones in the order (anchor, text)."""

    def __init__(self, found: wordhash.Words, anchors: pa.Table, window: int, anchor: int):
        valid, place, hashed, runs = _windows(found, window, anchor)
        wanted, index = np.unique(anchors.column("anchor").to_numpy(), return_index=True)
        flags = anchors.column("large").to_numpy(zero_copy_only=False)[index]
        own = runs[place].view(np.int64)
        at = np.minimum(np.searchsorted(wanted, own), max(0, len(wanted) - 1))
        hit = np.flatnonzero(wanted[at] == own) if len(wanted) and len(own) else np.zeros(0, np.int64)
        starts, place, own, large = valid[hit], place[hit], own[hit], flags[at[hit]] if len(hit) else np.zeros(0, bool)
        # Windows with one anchor follow each other; those of a large one stay alone.
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | large[1:]
        self.first = starts[new]
        self.windows = np.diff(np.append(np.flatnonzero(new), len(starts)))
        length = self.windows + window - 1 if len(self.first) else np.zeros(0, np.int64)
        text = _joined(found, self.first, length).dictionary_encode()
        self.index = text.indices.to_numpy()
        one = np.zeros(len(text.dictionary), np.int64)
        one[self.index] = np.arange(len(self.index))
        self.anchor, self.large = own[new][one], large[new][one]
        by = pa.table({"anchor": self.anchor, "text": text.dictionary, "place": np.arange(len(one))}).sort_by([("anchor", "ascending"), ("text", "ascending")]).column("place").to_numpy()
        # The distinct pieces in order; a piece is known to others by its anchor and its rank there.
        self.anchor, self.large, self.text = self.anchor[by], self.large[by], text.dictionary.take(pa.array(by))
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.index = back[self.index]
        fresh = np.flatnonzero(np.r_[True, self.anchor[1:] != self.anchor[:-1]][: len(by)])
        self.rank = np.arange(len(by)) - np.repeat(fresh, np.diff(np.append(fresh, len(by))))
        self.n = np.bincount(self.index, minlength=len(by))
        self.prefix = self.anchor.copy()
        if self.large.any():
            path = wordhash.runs(hashed, window, seed=21)[self.first[one][by[self.large]]]
            self.prefix[self.large] = wordhash.mix(self.anchor[self.large].view(np.uint64) ^ path).view(np.int64)


def _joined(found: wordhash.Words, first: np.ndarray, length: np.ndarray) -> pa.StringArray:
    """The given runs of words as texts with one space between words."""
    ends = np.cumsum(length)
    index = np.repeat(first - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), found.known.take(pa.array(found.number[index])))
    return pc.binary_join(lists, " ")


def _suffixes(window: int, anchor: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, anchors: pa.Table) -> pa.Table:
        p = _Pieces(wordhash.words(docs.column("text")), anchors, window, anchor)
        return pa.table({
            "batch": _batch(key, len(p.n)), "prefix": p.prefix, "anchor": p.anchor, "large": pa.array(p.large), "rank": pa.array(p.rank, pa.int32()), "n": p.n, "piece": p.text,
        })

    return run


class Tree(NamedTuple):
    """The suffixes of texts that have `window` words or more, in order: text, first word there, and the words
    shared with the suffix before (0 for the first)."""

    text: np.ndarray
    first: np.ndarray
    shared: np.ndarray


def suffix_tree(texts: pa.StringArray, window: int) -> Tree:
    """Suffixes of all texts in the order of their words (each text closed by a word of its own), with common prefixes."""
    found = wordhash.words(texts)
    per, count = found.per_text, len(found.per_text)
    number = np.empty(len(found.number) + count, np.int64)
    base = np.cumsum(per) - per + np.arange(count)
    number[np.arange(len(found.number)) + np.repeat(np.arange(count), per)] = found.number
    number[base + per] = len(found.known) + np.arange(count)
    ranks, span = [number], 1
    while 2 * span <= int(per.max(initial=0)):
        last = ranks[-1]
        after = np.concatenate([last[span:], np.zeros(min(span, len(last)), np.int64)])
        ranks.append(np.unique(last * (int(last.max()) + 1) + after, return_inverse=True)[1])
        span *= 2
    suffixes = np.maximum(per - window + 1, 0)
    text = np.repeat(np.arange(count), suffixes)
    first = np.arange(len(text)) - np.repeat(np.cumsum(suffixes) - suffixes, suffixes)
    place, end = base[text] + first, len(number) - 1
    # Two ranks reach past the longest text; a suffix that ends within the first of them ties with none.
    by = np.lexsort((ranks[-1][np.minimum(place + span, end)], ranks[-1][place]))
    left, right = place[by][:-1], place[by][1:]
    shared = np.zeros(max(0, len(by) - 1), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        shared += (ranks[k][np.minimum(left + shared, end)] == ranks[k][np.minimum(right + shared, end)]) * (1 << k)
    return Tree(text[by], first[by], np.concatenate([np.zeros(min(1, len(by)), np.int64), shared]))


def _trees(window: int, rows: int = 1 << 15, most: int = 1 << 16):
    """Pieces sorted by prefix -> the pieces with windows that occur twice, and which: bit k for their k-th."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for table in whole_groups(batches, "prefix", rows, most):
            fresh = table.num_rows
            if held is not None and held.column("prefix")[0].as_py() == table.column("prefix")[0].as_py():
                table = pa.concat_tables([held, table])
            text = table.column("piece").combine_chunks().dictionary_encode()
            # Equal pieces of batches are one leaf for each suffix, with the sum of their occurrences.
            index = text.indices.to_numpy()
            occurs = np.bincount(index, weights=table.column("n").to_numpy(), minlength=len(text.dictionary))
            tree = suffix_tree(text.dictionary, window)
            # A deep internal node: all suffixes that follow each other with `window` common words or more.
            node = np.cumsum(tree.shared < window) - 1
            deep = np.bincount(node, weights=occurs[tree.text])[node] >= 2
            mark = np.bincount(tree.text, weights=deep * 2.0**tree.first, minlength=len(occurs)).astype(np.int64)[index]
            out = table.select(["batch", "anchor", "large", "rank"]).append_column("mark", pa.array(mark))
            wanted = (mark > 0) & (table.column("batch").to_numpy() >= 0)
            yield from out.filter(pa.array(wanted)).combine_chunks().to_batches()
            windows = np.bincount(tree.text, minlength=len(occurs))[index]
            held = _unsettled(table, mark == (1 << windows) - 1, index) if fresh >= most else None

    return run


def _unsettled(table: pa.Table, settled: np.ndarray, index: np.ndarray) -> pa.Table:
    """Of a table whose last prefix may go on: its rows that are not marked whole, and one row of batch -1 for each piece that is."""
    prefix = table.column("prefix").to_numpy()
    one = np.zeros(len(prefix), bool)
    one[np.unique(index, return_index=True)[1]] = True
    batch = np.where(settled, -1, table.column("batch").to_numpy()).astype(np.int32)
    table = table.set_column(table.column_names.index("batch"), "batch", pa.array(batch))
    return table.filter(pa.array((prefix == prefix[-1]) & (~settled | one)))


def _cover(window: int, anchor: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, repeats: pa.Table) -> pa.Table:
        found = wordhash.words(docs.column("text"))
        p = _Pieces(found, repeats, window, anchor)
        marks = np.zeros(len(p.n), np.int64)
        if repeats.num_rows:
            begin = np.searchsorted(p.anchor, repeats.column("anchor").to_numpy())
            np.bitwise_or.at(marks, begin + repeats.column("rank").to_numpy(), repeats.column("mark").to_numpy())
        offset = np.arange(int(p.windows.sum())) - np.repeat(np.cumsum(p.windows) - p.windows, p.windows)
        repeated = np.repeat(marks[p.index], p.windows) >> offset & 1
        begins = (np.repeat(p.first, p.windows) + offset)[repeated == 1]
        cover = np.zeros(len(found.number) + 1, np.int64)
        np.add.at(cover, begins, 1)
        np.subtract.at(cover, begins + window, 1)
        gone = np.cumsum(cover)[:-1] > 0
        ends = np.cumsum(found.per_text)
        text = np.repeat(np.arange(len(ends)), found.per_text)
        removed = np.bincount(text[gone], minlength=len(ends))
        kept = np.concatenate([[0], np.cumsum(found.per_text - removed)])
        words = found.known.take(pa.array(found.number[~gone]))
        # Stretches of removed words in one text.
        edge = np.flatnonzero(gone & ~np.r_[False, gone[:-1] & (text[1:] == text[:-1])][: len(gone)])
        last = np.flatnonzero(gone & ~np.r_[gone[1:] & (text[1:] == text[:-1]), False][: len(gone)])
        base = (ends - found.per_text)[text[edge]]
        spans = pa.StructArray.from_arrays([pa.array(edge - base), pa.array(last + 1 - base)], ["first", "upto"])
        per = np.concatenate([[0], np.cumsum(np.bincount(text[edge], minlength=len(ends)))])
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_words": pa.array(found.per_text, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept": pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words), " "), "spans": pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans),
        })

    return run


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, group_rows: int = GROUP_ROWS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept and spans for each row of docs.

    Words covered by a window of `window` words that also starts anywhere else, in the same text
    included, are removed; all windows are judged on the input. kept: the words that stay, joined by one
    space; spans: the maximal stretches (first, upto) of word places that go. A null text has no words.
    Repeated rows repeat each other, so of rows with `window` words or more all words go. Null ids are
    kept as they are. Other columns are ignored; an empty table gives an empty result.
    """
    rows, _ = batched(docs, batch_bytes, F.col("doc_id").cast("long").alias("doc_id"))
    groups = rows.groupBy("batch")
    counted = groups.applyInArrow(_anchors(window, anchor), "batch int, anchor long, n long")
    twice = counted.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_repeated(group_rows), "batch int, anchor long, large boolean")
    pieces = groups.cogroup(twice.groupBy("batch")).applyInArrow(_suffixes(window, anchor), "batch int, prefix long, anchor long, large boolean, rank int, n long, piece string")
    marks = pieces.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_trees(window), "batch int, anchor long, large boolean, rank int, mark long")
    schema = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<first: long, upto: long>>"
    return groups.cogroup(marks.groupBy("batch")).applyInArrow(_cover(window, anchor), schema)
