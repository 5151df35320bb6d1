"""Phrases of two to five words that occur often, scored by how much more often than their parts would meet.

Documents are read once: each partition numbers its words and keeps its texts as number sequences, in batches of
bounded size. Only words that are frequent in their language get an id, so a phrase that could count is never broken and
all others are. Then phrases grow by a word a round: a batch's sequence holds at each place the id of the frequent phrase
that starts there; two neighbours are a phrase that is a word longer. They are counted in a HAT-trie: a shallow trie by
the ids of the first two words, whose leaves are hash containers that burst into more when they grow. When the trie
holds too many keys, whole subtrees leave it as sorted runs, cut by prefix partition. A partition's runs are
merged in one task, in arrays; what is frequent gets an id and goes back to the batches it is in. The partition is a hash of the prefix and
of the last part, so the phrases of a frequent word are in many, and their number grows with the places there are.

The phrases themselves, their texts and the frequencies of their parts come from joins of each round's table with the one before.
"""

from __future__ import annotations

from collections import _count_elements, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, materialise, slices

LEAST, LONGEST, TOP = 100, 5, 2000
#: Words of a batch, and of one row of its sequence.
BATCH_WORDS, ROW_WORDS = 4 << 20, 1 << 18
#: Keys of a container before it bursts, and of a trie before subtrees leave it.
BURST, MOST_KEYS = 1 << 13, 600_000
#: Places of all sequences for each prefix partition: no partition has more phrases of batches than it has places.
PART_PLACES = 4 << 20
#: Candidates that are ranked together before the last ranking of a language.
RANKED = 200_000
SPREAD = np.uint64(0x9E3779B97F4A7C15)
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Lower-cases A-Z, turns breaks to a byte that no UTF-8 has and tabs to spaces.
FOLD = bytes.maketrans(UPPER.encode() + BREAKS + b"\t", LOWER.encode() + b"\xff" * len(BREAKS) + b" ")

_NUMBERED = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("at", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("no", pa.int64()), ("n", pa.int64()), ("blob", pa.binary())])
_COUNTED = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("at", pa.int32()), ("n", pa.int64()), ("blob", pa.binary())])
_MERGED = pa.schema([("batch", pa.int64()), ("p", pa.int64()), ("s", pa.int64()), ("id", pa.int64()), ("f", pa.int64()), ("blob", pa.binary())])
_NUMBERED_SQL = "batch long, kind int, at int, lang string, word string, no long, n long, blob binary"
_COUNTED_SQL = "batch long, kind int, at int, n long, blob binary"
_MERGED_SQL = "batch long, p long, s long, id long, f long, blob binary"
#: Rows of a batch in the order in which they are read: what its numbers mean, ids of its sequence's places, the sequence; and runs.
MAP, NAMES, SEQUENCE, RUN = range(4)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length in one blob: bytes of like weight lie together, so high zeros cost nothing."""
    planes = [np.ascontiguousarray(a.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(blob: bytes, count: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(count, 8, -1)
    return [np.ascontiguousarray(a.T).view("<i8").ravel() for a in raw]


def _rows(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A record batch of so many rows; a number stands for that many of it, a column that is not given is null."""
    arrays = []
    for field in schema:
        v = columns.get(field.name)
        arrays.append(pa.nulls(rows, field.type) if v is None else pa.array(np.full(rows, v), field.type) if isinstance(v, int) else pa.array(v, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class _Numbers:
    """Words of a batch and their numbers, per language; 0 is a break between pieces or texts."""

    def __init__(self):
        self.next = count(1)
        self.of: dict[str, dict[bytes, int]] = {}
        self.counts = np.zeros(1 << 12, np.int64)
        self.words = self.rows = 0

    def sequence(self, lang: str, text: str) -> np.ndarray:
        known = self.of.get(lang)
        if known is None:
            known = self.of[lang] = defaultdict(self.next.__next__)
            known[b"\xff"] = 0
        words = text.encode().translate(FOLD).replace(b"\xff", b" \xff ").split()
        out = np.zeros(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
        return out

    def row(self, parts: list[np.ndarray]) -> bytes:
        whole = np.concatenate(parts)
        seen = np.bincount(whole)
        if len(seen) > len(self.counts):
            self.counts = np.append(self.counts, np.zeros(2 * len(seen) - len(self.counts), np.int64))
        self.counts[: len(seen)] += seen
        self.words += len(whole)
        self.rows += 1
        return _packed(whole)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    batch, held = TaskContext.get().partitionId() << 32, _Numbers()
    parts: list[np.ndarray] = []
    size = 0

    def sequence_row() -> pa.RecordBatch:
        nonlocal parts, size
        blob, n, parts, size = held.row(parts), size, [], 0
        return _rows(_NUMBERED, 1, batch=batch, kind=SEQUENCE, at=held.rows, n=n, blob=[blob])

    def word_rows() -> Iterator[pa.RecordBatch]:
        for lang, known in held.of.items():
            del known[b"\xff"]
            words, numbers = [w.decode() for w in known], np.fromiter(known.values(), np.int64, len(known))
            for a in range(0, len(words), 1 << 15):
                no = numbers[a : a + (1 << 15)]
                yield _rows(_NUMBERED, len(no), batch=batch, kind=MAP, lang=[lang] * len(no), word=words[a : a + (1 << 15)], no=no, n=held.counts[no])

    for big in batches:
        for b in slices(big, 1):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts.append(held.sequence(lang, text))
                size += len(parts[-1])
                if size >= ROW_WORDS:
                    yield sequence_row()
                    if held.words >= BATCH_WORDS:
                        yield from word_rows()
                        batch, held = batch + 1, _Numbers()
    if parts:
        yield sequence_row()
    yield from word_rows()


class Container:
    """A hash container: key -> count of phrases whose word at this depth is in a range."""

    def __init__(self):
        self.counts: dict[int, int] = {}

    def __len__(self) -> int:
        return len(self.counts)

    def items(self) -> list[tuple[np.ndarray, np.ndarray]]:
        n = len(self.counts)
        return [(np.fromiter(self.counts, np.int64, n), np.fromiter(self.counts.values(), np.int64, n))]


class Node:
    """A node of the trie: children by ranges of the word at its depth; each is a container or, for one word, a node."""

    def __init__(self):
        self.starts = [0]
        self.children: list[Container | Node] = [Container()]

    def items(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [x for c in self.children for x in c.items()]

    def __len__(self) -> int:
        return sum(map(len, self.children))


class HatTrie:
    """Counts of phrases. A key is first part << 32 | second part, in a batch's numbers; words[k] is the number's first word,
    so a key's path is (words of its first part, words of its second part)."""

    def __init__(self, words: np.ndarray, burst: int = BURST, most: int = MOST_KEYS):
        self.words, self.burst, self.most, self.root = words, burst, most, Node()

    def _word(self, keys: np.ndarray, depth: int) -> np.ndarray:
        return self.words[keys >> 32 if depth == 0 else keys & 0xFFFFFFFF]

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        paths = self.words[first] << 32 | self.words[second]
        order = np.argsort(paths)
        paths = paths[order]
        self._add(self.root, 0, (paths >> 32, paths & 0xFFFFFFFF), (first[order] << 32 | second[order]).tolist(), 0, len(paths))

    def _add(self, node: Node, depth: int, paths: tuple[np.ndarray, np.ndarray], keys: list[int], lo: int, hi: int) -> None:
        cuts = lo + np.searchsorted(paths[depth][lo:hi], [*node.starts, 1 << 62])
        cuts[0] = lo
        full = []
        for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            child = node.children[i]
            if a == b:
                continue
            if isinstance(child, Node):
                self._add(child, depth + 1, paths, keys, a, b)
            else:
                _count_elements(child.counts, keys[a:b])
                if len(child) > self.burst:
                    full.append(i)
        for i in reversed(full):
            node.starts[i : i + 1], node.children[i : i + 1] = self._burst(node.starts[i], node.children[i], depth)

    def _burst(self, start: int, container: Container, depth: int) -> tuple[list[int], list[Container | Node]]:
        """What takes a container's place: containers over narrower ranges, or a node where it holds one word."""
        (keys, counts), = container.items()
        word = self._word(keys, depth)
        order = np.argsort(word, kind="stable")
        keys, counts, word = keys[order], counts[order], word[order]
        borders = np.unique(word[:: max(1, self.burst // 2)])
        borders = borders[borders > word[0]]
        if not len(borders) and word[-1] > word[0]:
            borders = word[-1:]
        if not len(borders):
            if depth:
                return [start], [container]  # one pair of words: the trie is no deeper
            node = Node()
            node.children = [container]
            node.starts, node.children = self._burst(0, container, 1)
            return [start], [node]
        children = []
        at = [0, *np.searchsorted(word, borders).tolist(), len(word)]
        for a, b in zip(at, at[1:]):
            children.append(Container())
            children[-1].counts = dict(zip(keys[a:b].tolist(), counts[a:b].tolist()))
        return [start, *borders.tolist()], children

    def spill(self, everything: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted runs (keys, counts) of whole subtrees, the largest first, where there are too many keys."""
        sizes = [len(c) for c in self.root.children]
        left = sum(sizes)
        if not everything and left <= self.most:
            return
        for i in np.argsort(-np.array(sizes)).tolist():
            if not sizes[i] or (not everything and left <= self.most // 2):
                break
            found = self.root.children[i].items()
            self.root.children[i] = Container()
            left -= sizes[i]
            keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])
            order = np.argsort(keys)
            yield keys[order], counts[order]


def _part(p: np.ndarray, s: np.ndarray, parts: int) -> np.ndarray:
    """Prefix partition of phrases: by a product of both ids, so that the phrases of one prefix are spread."""
    mixed = p.astype(np.uint64) * SPREAD ^ (s.astype(np.uint64) * SPREAD >> np.uint64(17))
    return ((mixed * SPREAD >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


class _Batch:
    """A batch in a round: its numbers' ids and first words, its trie."""

    def __init__(self, number: int, names: np.ndarray | None, maps: list[np.ndarray], level: int, parts: int):
        self.number, self.level, self.row, self.parts = number, level, 0, parts
        p, s, ids = np.concatenate(maps, axis=1)
        if level == 2:
            # Words: p is the word's number.
            self.table = np.zeros(int(p.max(initial=0)) + 1, np.int64)
            self.table[p] = np.arange(1, len(p) + 1)
            self.ids, self.first = np.append(0, ids), np.append(0, ids)
        else:
            old_ids, old_first = names
            order = np.argsort(old_ids)
            place = lambda x: order[np.searchsorted(old_ids, x, sorter=order)]
            p, s = place(p), place(s)
            keys, pick = np.unique(p << 32 | s, return_index=True)
            self.keys, self.ids, self.first = keys, np.append(0, ids[pick]), np.append(0, old_first[p[pick]])
        words, dense = np.unique(self.first, return_inverse=True)
        self.trie = HatTrie(dense.astype(np.int64))

    def names(self) -> pa.RecordBatch:
        return _rows(_COUNTED, 1, batch=self.number, kind=NAMES, at=0, n=0, blob=[_packed(self.ids, self.first)])

    def relabelled(self, sequence: np.ndarray) -> np.ndarray:
        """The sequence by this round's numbers; 0 where no frequent phrase starts, and only one 0 in a row."""
        if self.level == 2:
            out = np.where(sequence < len(self.table), self.table[np.minimum(sequence, len(self.table) - 1)], 0)
        else:
            pair = sequence[:-1] << 32 | sequence[1:]
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            out = np.where(self.keys[at] == pair, at + 1, 0) if len(self.keys) else np.zeros(len(pair), np.int64)
        keep = out > 0
        keep[1:] |= out[:-1] > 0
        return out[keep]

    def read(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        # Rows end with a text, so no phrase goes over their border.
        sequence = self.relabelled(_unpacked(blob, 1)[0])
        both = np.flatnonzero((sequence[:-1] > 0) & (sequence[1:] > 0))
        if not len(both):
            return
        self.row += 1
        yield _rows(_COUNTED, 1, batch=self.number, kind=SEQUENCE, at=self.row, n=len(sequence) + 1, blob=[_packed(np.append(sequence, 0))])
        self.trie.add(sequence[both], sequence[both + 1])
        yield from self.runs()

    def runs(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """What leaves the trie, cut by prefix partition."""
        spilled = list(self.trie.spill(everything))
        if not spilled:
            return
        keys, n = (np.concatenate(x) for x in zip(*spilled))
        p, s = self.ids[keys >> 32], self.ids[keys & 0xFFFFFFFF]
        part = _part(p, s, self.parts)
        order = np.lexsort((s, p, part))
        p, s, n, part = p[order], s[order], n[order], part[order]
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for lo in range(0, len(cuts) - 1, 256):
            some = list(zip(cuts[lo : lo + 256], cuts[lo + 1 : lo + 257]))
            blobs = [_packed(np.diff(p[a:b], prepend=0), s[a:b], n[a:b]) for a, b in some]
            yield _rows(_COUNTED, len(blobs), batch=self.number, kind=RUN, at=part[[a for a, _ in some]].astype(np.int32), n=np.array([b - a for a, b in some]), blob=blobs)


def _count(level: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Batch | None = None
        number, names, maps = None, None, []
        for big in batches:
            numbers, kinds = big.column("batch").to_numpy(), big.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), big.num_rows]):
                if a == b:
                    continue
                part = big.slice(a, b - a)
                if numbers[a] != number:
                    if own is not None:
                        yield from own.runs(True)
                    own, names, maps, number = None, None, [], int(numbers[a])
                if kinds[a] == MAP and level == 2:
                    no, ids = (part.column(c).to_numpy() for c in ("no", "n"))
                    maps.append(np.stack([no, 0 * no, ids]))
                elif kinds[a] == MAP:
                    maps += [np.stack(_unpacked(x.as_py(), 3)) for x in part.column("blob")]
                elif kinds[a] == NAMES:
                    names = _unpacked(part.column("blob")[0].as_py(), 2)
                elif maps or own is not None:
                    if own is None:
                        own, maps = _Batch(number, names, maps, level, parts), []
                        yield own.names()
                    for blob in part.column("blob"):
                        yield from own.read(blob.as_py())
        if own is not None:
            yield from own.runs(True)

    return run


def _merge(least: int, parts: int):
    """Runs of prefix partitions, one after the other -> frequent phrases (p, s, id, f), and a blob of (p, s, id) for each batch."""

    def merged(part: int, batch: list[int], blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        runs = [_unpacked(b, 3) for b in blobs]
        size = np.array([len(r[0]) for r in runs])
        p, s, n = (np.concatenate(x) for x in ([np.cumsum(r[0]) for r in runs], [r[1] for r in runs], [r[2] for r in runs]))
        source = np.repeat(np.array(batch, np.int64), size)
        order = np.lexsort((s, p))
        p, s, n, source = p[order], s[order], n[order], source[order]
        first = np.flatnonzero(np.append(True, (np.diff(p) != 0) | (np.diff(s) != 0)))
        f = np.add.reduceat(n, first)
        good = f >= least
        if not good.any():
            return
        # Dense: the k-th frequent phrase of the partition.
        ids = np.cumsum(good) * parts + part
        yield _rows(_MERGED, int(good.sum()), p=p[first[good]], s=s[first[good]], id=ids[good], f=f[good])
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(p))))
        keep = good[group]
        p, s, own, source = p[keep], s[keep], ids[group[keep]], source[keep]
        order = np.argsort(source, kind="stable")
        p, s, own, source = p[order], s[order], own[order], source[order]
        cuts = [0, *(np.flatnonzero(np.diff(source)) + 1).tolist(), len(source)]
        for lo in range(0, len(cuts) - 1, 256):
            some = list(zip(cuts[lo : lo + 256], cuts[lo + 1 : lo + 257]))
            yield _rows(_MERGED, len(some), batch=source[[a for a, _ in some]], blob=[_packed(p[a:b], s[a:b], own[a:b]) for a, b in some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, ([], [])
        for b in batches:
            for at, batch, blob in zip(*(b.column(c).to_pylist() for c in ("at", "batch", "blob"))):
                if at != part:
                    if held[0]:
                        yield from merged(part, *held)
                    part, held = at, ([], [])
                held[0].append(batch)
                held[1].append(blob)
        if held[0]:
            yield from merged(part, *held)

    return run


def _frequent(rows: DataFrame, key: list[str], least: int, name: str) -> DataFrame:
    """Rows whose key has `least` in all, with f and an id per key; head: one row of each key. Written down, so ids stay."""
    same = Window.partitionBy(*key)
    found = rows.withColumn("uid", F.monotonically_increasing_id() + 1)
    found = found.withColumns({"f": F.sum("n").over(same), "id": F.min("uid").over(same)}).where(F.col("f") >= least)
    return materialise(found.withColumn("head", F.col("uid") == F.col("id")).drop("uid"), name)


def phrases(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score, k (words before the cut): each language's first `top` phrases.

    Texts are lower-cased (A-Z), cut at [.,;:!?] and line ends into pieces and at spaces and tabs into words; a phrase
    lies within a piece. A null text is empty; a null language is `und`. n: words of the language; a: times that the phrase occurs, at least
    `least`; its score floor(1000 a n / (l r)) is the lowest of its cuts into parts that occur l and r times, at equal scores
    that of the shortest first part. A phrase within a longer one that occurs as often is left out. Repeated rows count each; other
    columns are ignored; an empty table gives an empty result.
    """
    text = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    read = materialise(text.mapInArrow(_number, _NUMBERED_SQL), "phrase-words")
    words = read.where(F.col("kind") == MAP).select("batch", "lang", "word", "no", "n")
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("total")), "phrase-totals")
    marked = _frequent(words, ["lang", "word"], least, "phrase-vocabulary")
    table = marked.where("head").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array().cast("array<bigint>").alias("pf"), F.array().cast("array<bigint>").alias("sf"))
    maps = marked.select("batch", "no", F.col("id").alias("n"))
    before, tables = read, []
    for level in range(2, longest + 1):
        sequences = before.where(F.col("kind").isin(NAMES, SEQUENCE)).select("batch", "kind", "at", "n", "blob")
        places = sequences.where(F.col("kind") == SEQUENCE).agg(F.sum("n")).first()[0] or 0
        parts = max(1, -(-places // PART_PLACES))
        given = maps.select(F.lit(MAP).alias("kind"), F.lit(0).alias("at"), *maps.columns).unionByName(sequences, allowMissingColumns=True)
        counted = materialise(given.repartition("batch").sortWithinPartitions("batch", "kind", "at").mapInArrow(_count(level, parts), _COUNTED_SQL), f"phrase-{level}")
        discard(before)
        runs = counted.where(F.col("kind") == RUN).select("at", "batch", "blob")
        merged = materialise(runs.repartition("at").sortWithinPartitions("at").mapInArrow(_merge(least, parts), _MERGED_SQL), f"phrase-{level}-frequent")
        p, s = table.alias("p"), table.alias("s")
        joined = merged.where("id is not null").alias("g").join(p, F.col("g.p") == F.col("p.id")).join(s, F.col("g.s") == F.col("s.id"))
        table = materialise(joined.select(
            "g.id", "p.lang", F.concat_ws(" ", "p.phrase", "s.last").alias("phrase"), "s.last", "g.f", F.concat("p.pf", F.array("p.f")).alias("pf"), F.concat("s.sf", F.array("s.f")).alias("sf"),
            F.when(F.col("g.f") == F.col("p.f"), F.col("g.p")).alias("covers_p"), F.when(F.col("g.f") == F.col("s.f"), F.col("g.s")).alias("covers_s")), f"phrase-{level}-table")
        tables.append(table)
        maps, before = merged.where("batch is not null").select("batch", "blob"), counted
    discard(before)
    found = None
    for shorter, longer in zip(tables, [*tables[1:], None]):
        if longer is not None:
            covered = longer.select(F.explode(F.array("covers_p", "covers_s")).alias("id")).where("id is not null").distinct()
            shorter = shorter.join(covered, "id", "left_anti")
        shorter = shorter.select("lang", "phrase", "f", "pf", "sf")
        found = shorter if found is None else found.unionByName(shorter)
    return _ranked(found, totals, top)


def _ranked(found: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    # Products of two LONGs have up to 38 digits; an overflow of those would be an error, not a wrong score.
    part = lambda x: f"cast({x} AS decimal(19,0))"
    cuts = f"""transform(sequence(1, size(pf)), k -> struct(({part('f')} * {part('total')} * 1000BD) div ({part('element_at(pf, k)')} * {part('element_at(sf, size(sf) - k + 1)')}) AS score,
      k, element_at(pf, k) AS l, element_at(sf, size(sf) - k + 1) AS r))"""
    scored = found.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), F.col("total").alias("n"), F.array_min(F.expr(cuts)).alias("cut"))
    scored = materialise(scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "cut.k"), "phrase-scores")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # A language's best of each part, then of all: the parts grow in number, not in size.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(max(1, -(-scored.count() // RANKED))))
    first = scored.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")


#: DuckDB SQL for the query.
ORACLE = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
grams AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM starts, range(1, 6) r(m) WHERE i + m - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
cands AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE m > 1 AND f >= 100),
cuts AS (SELECT c.lang, c.m, c.phrase, c.a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cands) c JOIN totals USING (lang)
  JOIN grams x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(ws[:k], ' ') JOIN grams y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(ws[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cands c WHERE c.lang = b.lang AND c.m > b.m AND 100 * c.a >= 100 * b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000
"""
