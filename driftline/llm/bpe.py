"""Byte-level BPE: text to ids and back, from a public tokenizer's file.

A text is cut at added tokens and then by the tokenizer's pattern. A short word is held as a contiguous array: the
ids of its parts (their boundaries) beside the rank of each adjacent pair. The array is scanned for the smallest rank, the
boundary there is deleted and the ranks of both neighbours are looked up again, until no pair has a rank. A long
word, where repeated scans would take the square of its length, has a heap over linked parts; both merge the leftmost
pair of the smallest rank first, so they agree. The arrays of words of like length are the rows of one matrix, so that a step
of all of them is a few numpy operations.

Nothing is shuffled: each partition of documents is encoded where it is read. A word's ids are kept until the table of words
is full, so memory does not grow with the texts.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import free_name, per_process, slices
from .packing import default_tokenizer

#: Bytes up to which a word is short: scans of an array this long beat a heap.
SHORT = 96
#: Words whose ids are kept, and their characters together; more words are met before the table starts anew only where one slice of
#: texts has them.
KEPT_WORDS, KEPT_BYTES = 3 << 17, 8 << 20
#: Words whose arrays are scanned together.
GROUP_WORDS = 1 << 12
NO_RANK = 1 << 62
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable Latin-1 (no
    space), else the next character from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizers file says: ids of bytes, ranks of pairs, added tokens, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before, after = spec["model"], spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or after.get("type") != "ByteLevel" or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if before.get("add_prefix_space") or not before.get("use_regex", True) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} splits texts in a way that is not supported")
        ids, symbols = model["vocab"], byte_symbols()
        self.path = path
        self.byte_ids = [ids[s] for s in symbols]
        #: A pair of ids is one number, a << bits | b; so is what it has: rank << bits | id of the merged part.
        self.bits = max(ids.values()).bit_length()
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[a] << self.bits | ids[b]] = rank << self.bits | ids[a + b]
        self._index()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        value = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(map(value.__getitem__, s)) for s, i in ids.items()}
        # An added token's characters are decoded as symbols where all of them are, else as they stand.
        self.bytes_of |= {i: bytes(map(value.__getitem__, s)) if all(c in value for c in s) else s.encode() for s, i in self.added.items()}

    def pieces(self) -> list[bytes]:
        """The bytes of every id up to the largest; none for ids between that are not used."""
        return [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    def _index(self) -> None:
        """The pairs in an open hash table of numpy arrays: an eighth to a quarter full, slots from the key's product."""
        keys = np.fromiter(self.ranks, np.uint64, len(self.ranks))
        self.shift = np.uint64(64 - max(10, (4 * len(keys)).bit_length()))
        self.slot_keys = np.full(1 << (64 - int(self.shift)), 1 << 63, np.uint64)
        self.slot_ranks = np.full(len(self.slot_keys), NO_RANK, np.int64)
        wrap = len(self.slot_keys) - 1
        for key, slot, rank in zip(keys.tolist(), (keys * SPREAD >> self.shift).tolist(), self.ranks.values()):
            while self.slot_ranks[slot] != NO_RANK:
                slot = (slot + 1) & wrap
            self.slot_keys[slot], self.slot_ranks[slot] = key, rank
        every = np.arange(256)
        self.byte_array = np.array(self.byte_ids, np.int64)
        self.byte_pairs = self.rank(self.byte_array[every[:, None]].repeat(256, 1).ravel(), np.tile(self.byte_array, 256))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_RANK where there is none."""
        keys = (left << self.bits | right).astype(np.uint64)
        slots = (keys * SPREAD >> self.shift).astype(np.int64)
        found, open_ = self.slot_ranks[slots], np.flatnonzero(self.slot_keys[slots] != keys)
        while len(open_):
            empty = self.slot_ranks[slots[open_]] == NO_RANK
            found[open_[empty]] = NO_RANK
            open_ = open_[~empty]
            slots[open_] = (slots[open_] + 1) & (len(self.slot_keys) - 1)
            found[open_] = self.slot_ranks[slots[open_]]
            open_ = open_[self.slot_keys[slots[open_]] != keys[open_]]
        return found

    def short(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32 bits) of words of one to SHORT bytes: a row of parts and of adjacent ranks for each word, all
        rows a step at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        width, low = int(size.max()), (1 << self.bits) - 1
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width).astype(np.int64)
        parts, at = self.byte_array[raw], np.arange(width)
        ranks = np.where(at[:-1] < size[:, None] - 1, self.byte_pairs[raw[:, :-1] << 8 | raw[:, 1:]], NO_RANK)
        done, left, rows = parts.copy(), size.copy(), np.arange(len(words))
        while len(rows) and ranks.shape[1]:
            i = ranks.argmin(axis=1)  # the leftmost of equal ranks
            own = np.arange(len(rows))
            least = ranks[own, i]
            if (still := least != NO_RANK).sum() < len(rows):
                ended = rows[~still]
                done[ended, : parts.shape[1]], left[ended] = parts[~still], size[~still]
                parts, ranks, size, rows, i, least = parts[still], ranks[still], size[still], rows[still], i[still], least[still]
                own = own[: len(rows)]
                if not len(rows):
                    break
            parts[own, i] = least & low
            # The boundary after i goes: what is behind it moves up by one.
            parts = np.where(at[: parts.shape[1] - 1] > i[:, None], parts[:, 1:], parts[:, :-1])
            moved = np.where(at[: ranks.shape[1] - 1] >= i[:, None], ranks[:, 1:], ranks[:, :-1])
            size = size - 1
            before, behind = np.flatnonzero(i > 0), np.flatnonzero(i < size - 1)
            moved[before, i[before] - 1] = self.rank(parts[before, i[before] - 1], parts[before, i[before]])
            moved[behind, i[behind]] = self.rank(parts[behind, i[behind]], parts[behind, i[behind] + 1])
            ranks = moved
        done[rows, : parts.shape[1]], left[rows] = parts, size
        flat = done[at < left[:, None]].astype("<i4").tobytes()
        ends = (4 * left.cumsum()).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def long(self, word: bytes) -> list[int]:
        """Ids of a word by a heap of (rank and merged id, place, pair) over linked parts."""
        bits, n = self.bits, len(word)
        parts = [self.byte_ids[b] for b in word]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int]] = []

        def meet(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.ranks.get(pair := parts[i] << bits | parts[j])) is not None:
                heapq.heappush(heap, (found, i, pair))

        for i in range(n - 1):
            meet(i, i + 1)
        while heap:
            found, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or parts[i] << bits | parts[j] != pair:
                continue
            parts[i], parts[j], after[i] = found & ((1 << bits) - 1), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            meet(before[i], i)
            meet(i, after[i])
        return [p for p in parts if p >= 0]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of words in any order: short ones in groups of like length, long ones alone."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        size, at = size[order], 0
        while at < len(order):
            n = int(size[at])
            if n > SHORT:
                out[order[at]] = np.array(self.long(words[order[at]]), "<i4").tobytes()
                at += 1
                continue
            upto = min(at + GROUP_WORDS, int(np.searchsorted(size, min(SHORT, n + n // 4), "right")))
            group = order[at:upto].tolist()
            for i, ids in zip(group, self.short([words[i] for i in group])):
                out[i] = ids
            at = upto
        return out


def _is_plain(c: str) -> bool:
    """Whether re's classes tell what the pattern's do: letters, decimal digits, white space and the rest."""
    kind = unicodedata.category(c)
    return kind != "Cn" and kind not in ("Nl", "No") and not "\x1c" <= c <= "\x1f"


class Encoder:
    """texts -> ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        self.vocabulary = Vocabulary(path)
        self.words: dict[str, bytes] = {}
        self.size = 0
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # The same pattern in re's classes, several times faster, with letters first, which no other alternative begins with.
        self.plain_pattern = re.compile(r" ?[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.plain: set[str] = {chr(c) for c in range(128) if _is_plain(chr(c))}
        self.splitter = None

    def _split(self, text: str) -> list[str]:
        odd = set(text) - self.plain
        if odd:
            plain = {c for c in odd if _is_plain(c)}
            self.plain |= plain
            odd -= plain
        if not odd:
            return self.plain_pattern.findall(text)
        if any(unicodedata.category(c) == "Cn" for c in odd):
            # A character newer than Python's tables may be a letter in some and none in others: the library cuts its text.
            if self.splitter is None:
                from tokenizers import Tokenizer

                self.splitter = Tokenizer.from_file(self.vocabulary.path).pre_tokenizer
            return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. All short words of these texts are in the table when the texts are put together."""
        split: list[list[tuple[bytes, list[str]]]] = []  # (id of the added token before it, words) of each stretch
        for text in texts:
            parts = ["", *(self.cut.split(text) if self.cut else [text])]
            added = [self.vocabulary.added.get(t) for t in parts[::2]]
            split.append([(b"" if i is None else np.array([i], "<i4").tobytes(), self._split(t) if t else []) for i, t in zip(added, parts[1::2])])
        met: set[str] = set()
        for stretches in split:
            for _, words in stretches:
                met.update(words)
        new = met - self.words.keys()
        if len(self.words) + len(new) > KEPT_WORDS or self.size > KEPT_BYTES:
            self.words, self.size, new = {}, 0, met
        order = list(new)
        self.words.update(zip(order, self.vocabulary.encode([w.encode() for w in order])))
        self.size += sum(map(len, order))
        ids = self.words.__getitem__
        return [np.frombuffer(b"".join(token + b"".join(map(ids, words)) for token, words in stretches), "<i4") for stretches in split]


def encode(docs: DataFrame, *, tokenizer: str | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with a column ids: the ids of the whole text, no special tokens added.

    An added token's string in a text is that token. A null text is empty and has no ids. Repeated rows are encoded each; an empty
    table gives an empty result. The column ids replaces one of that name (case does not count); all others stay. tokenizer: path
    of a byte-level BPE file of the tokenizers library that exists on every executor.
    """
    path = tokenizer or default_tokenizer()
    rest = [c for c in docs.columns if c.lower() != ids_col.lower()]
    name = free_name(docs.columns, "_text")
    whole = docs.select(*rest, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(name))
    schema = docs.select(*rest).schema.add(ids_col, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_process(("bpe", path), lambda: Encoder(path))
        for big in batches:
            for b in slices(big, big.num_columns - 1):
                ids = coder.encode(b.column(b.num_columns - 1).to_pylist())
                offsets = np.cumsum([0, *map(len, ids)])
                array = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], array], [*rest, ids_col])

    return whole.mapInArrow(run, schema)


def decode(rows: DataFrame, *, tokenizer: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """rows with a column decoded in the place of ids: the text of the ids, added tokens by their strings.

    Bytes that are no UTF-8 become U+FFFD; ids that the vocabulary lacks, nulls among them, are left out. A null list is empty. An
    empty table gives an empty result.
    """
    path = tokenizer or default_tokenizer()
    rest = [c for c in rows.columns if c.lower() not in (ids_col.lower(), out_col.lower())]
    schema = rows.select(*rest).schema.add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_process(("bpe ids", path), lambda: Vocabulary(path).pieces())
        size = len(pieces)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                texts = []
                for ids in b.column(b.num_columns - 1):
                    ids = ids.values.drop_null().to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, int)
                    ids = ids[(ids >= 0) & (ids < size)]
                    texts.append(b"".join(map(pieces.__getitem__, ids.tolist())).decode(errors="replace"))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*rest, out_col])

    return rows.select(*rest, F.col(ids_col).cast("array<int>").alias(ids_col)).mapInArrow(run, schema)
