"""MinHash near-dedup: circulant signatures, banding, exact Jaccard on full shingle sets.

Rows with equal lower-cased texts form one class, known by the text's SHA-256; all that follows is between
classes, so copies cost one count each. Two permutations make the whole signature: the first (of the
shingle's hash) picks a place on a ring, the second gives the values, and coordinate k reads them shifted by k.
Hashes only find candidates; set sizes and links come from the words of whole texts.

Links are found without emitting the pairs of a bucket:
1. every class is compared in full with the smallest class it shares a bucket with;
2. then with the smallest class of each of its other buckets, unless both are already connected;
3. buckets that still hold classes of several components are cut into blocks; a pair of blocks
   compares the full sets of its members by matrix products, and returns the few links that join its components up.
Steps 1 and 2 send one row per class and bucket, and the text of a class that many others are compared with once
per SALT_ROWS of them; step 3 sends as many rows per class as its bucket has blocks. Components are settled by
min-label steps on the verified links. With 32 bands of 4 coordinates a pair at similarity 0.75 shares a bucket
with probability 1 - 6e-6, and more above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import WORD, ascii_lower, free_name, materialise, slices

WIDTH = 5
PERCENT = 75
BANDS, ROWS = 32, 4
RING = 1 << 18
#: Members of a bucket, and shingles of their sets, that one block holds in step 3.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
#: Classes that are compared with one copy of another's text.
SALT_ROWS = 2000
#: Rows of the ring that are read at a time.
RING_ROWS = 4096


def _ring(coordinates: int, ring: int) -> np.ndarray:
    values = np.random.default_rng(7).permutation(ring).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:coordinates]]), coordinates)


def _signatures(width: int, coordinates: int, ring: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _ring(coordinates, ring)
        for big in batches:
            for b in slices(big, 2):
                found = wordhash.words(b.column(2))
                owner, _, place = wordhash.shingles(found, width)
                values = _shingle_hashes(found, place, owner, width)
                n = np.bincount(owner, minlength=b.num_rows)
                where = (wordhash.mix(values) & np.uint64(ring - 1)).astype(np.int64)
                sigs = []
                for text in np.split(where, np.cumsum(n)[:-1]):
                    parts = [table[text[k : k + RING_ROWS]].min(axis=0) for k in range(0, len(text), RING_ROWS)]
                    sigs += [np.minimum.reduce(parts)] if parts else []
                ends = np.concatenate([[0], np.cumsum((n > 0) * coordinates)]).astype(np.int32)
                flat = np.concatenate([*sigs, np.zeros(0, np.int32)])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "sha", "n_shingles", "sig"])

    return run


def _shingle_hashes(found: wordhash.Words, place: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles at the given first words, the same in every batch."""
    if not len(place):
        return np.zeros(0, np.uint64)
    hashed = wordhash.hashes(found.known)[found.number]
    length = np.minimum(found.per_text[owner], width)
    out = np.empty(len(place), np.uint64)
    for k in np.unique(length).tolist():
        out[length == k] = wordhash.runs(hashed, k, seed=11 + k)[place[length == k]]
    return out


def _sets(texts: pa.Array | pa.ChunkedArray, width: int) -> list[np.ndarray]:
    """Sorted names of the distinct shingles of each text; equal names in any of them mean equal shingles."""
    owner, name, _ = wordhash.shingles(wordhash.words(texts), width)
    return np.split(name, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])


def similar(common: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return common * 100 >= PERCENT * (left + right - common)


def _confirm(width: int):
    """(a, b, text of a, text of b) -> the pairs that are similar on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in slices(big, 2, 3):
                # Many pairs have one text in common.
                texts = pa.chunked_array([b.column(2), b.column(3)]).combine_chunks().dictionary_encode()
                index = texts.indices.to_numpy().reshape(2, -1)
                sets = _sets(texts.dictionary, width)
                size = np.array([len(s) for s in sets])[index]
                pair = np.arange(b.num_rows)
                keys = np.concatenate([sets[k] for side in index for k in side])
                owner = np.concatenate([np.repeat(pair, n) for n in size])
                by = np.lexsort((keys, owner))
                twice = (keys[by][1:] == keys[by][:-1]) & (owner[by][1:] == owner[by][:-1])
                common = np.bincount(owner[by][1:][twice], minlength=b.num_rows)
                ok = pa.array(similar(common, size[0], size[1]))
                yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["a", "b"])

    return run


def intersections(left: list[np.ndarray], right: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets: products of 0/1 matrices over
    `chunk` shared shingles at a time. Sums stay whole in single precision below 2^24."""
    sides, shared = [], np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)))
    for sets in (left, right):
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        place = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = shared[place] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(place[hit], kind="stable")
        sides.append((place[hit][order], row[hit][order], len(sets)))
    total = np.zeros((len(left), len(right)))
    for at in range(0, len(shared), chunk):
        parts = []
        for place, row, n in sides:
            lo, hi = np.searchsorted(place, [at, at + chunk])
            m = np.zeros((n, min(chunk, len(shared) - at)), np.float32)
            m[row[lo:hi], place[lo:hi] - at] = 1
            parts.append(m)
        total += parts[0] @ parts[1].T
    return total.astype(np.int64)


def _block_links(bands: int, width: int):
    """Links between components inside a pair of blocks of one bucket, as many as join them up.

    A pair of classes is looked at in the first of the bands that they share only, and where their
    sizes leave the similarity possible.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        ids, comp, n, block = (table.column(c).to_numpy() for c in ("class", "comp", "n_shingles", "block"))
        band = table.column("band")[0].as_py()
        sig = np.stack(table.column("sig").to_numpy()).reshape(len(ids), bands, -1)
        i, j = key[-2].as_py(), key[-1].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        wanted = np.zeros((len(left), len(right)), bool)
        for r, x in enumerate(left):
            ok = (comp[right] != comp[x]) & (np.minimum(n[right], n[x]) * 100 >= PERCENT * np.maximum(n[right], n[x]))
            if i == j:
                ok &= right > x
            at = np.flatnonzero(ok)
            ok[at] = (sig[right[at]] == sig[x]).all(axis=2).argmax(axis=1) == band
            wanted[r] = ok
        rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        found: list[tuple[int, int]] = []
        if len(rows):
            left, right, wanted = left[rows], right[columns], wanted[np.ix_(rows, columns)]
            sets = _sets(table.column("text").take(pa.array(np.concatenate([left, right]))), width)
            common = intersections(sets[: len(left)], sets[len(left) :])
            link = wanted & similar(common, n[left][:, None], n[right])
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for r, c in zip(*np.nonzero(link)):
                p, q = root(int(comp[left[r]])), root(int(comp[right[c]]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    found.append((int(ids[left[r]]), int(ids[right[c]])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(class, comp): labels with links (a, b) merged; comp is the smallest class of a component.

    Each step works on components, not classes: a component takes the smallest label among itself
    and its neighbours, labels are followed once more, and links inside a component go. Steps grow
    with the logarithm of the longest path in practice; rows per step are the links left.
    """
    edges = materialise(
        links.join(labels.select(F.col("class").alias("a"), F.col("comp").alias("x")), "a")
        .join(labels.select(F.col("class").alias("b"), F.col("comp").alias("y")), "b")
        .where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(),
        "links",
    )
    moves = None
    while not edges.isEmpty():
        both = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        first = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # Follow the label twice: hooks point to smaller labels, so chains shorten by half.
        second = first.select(F.col("x").alias("m"), F.col("m").alias("mm"))
        step = materialise(first.join(second, "m").select("x", F.least("m", "mm").alias("m")), "step")
        moves = step if moves is None else materialise(
            moves.join(step.select(F.col("x").alias("m"), F.col("m").alias("to")), "m", "left").select("x", F.coalesce("to", "m").alias("m"))
            .unionByName(step.join(moves.select("x"), "x", "left_anti")), "moves")
        edges = materialise(
            edges.join(step.select("x", F.col("m").alias("p")), "x").join(step.select(F.col("x").alias("y"), F.col("m").alias("q")), "y")
            .where("p <> q").select(F.greatest("p", "q").alias("x"), F.least("p", "q").alias("y")).distinct(), "links")
    if moves is None:
        return labels
    to = moves.select(F.col("x").alias("comp"), F.col("m").alias("to"))
    return materialise(labels.join(to, "comp", "left").select("class", F.coalesce("to", "comp").alias("comp")), "labels")


def _compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar. Few a stand in many pairs: their texts are copied once per SALT_ROWS pairs."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    copies = salts.join(texts.select(F.col("class").alias("a"), F.col("text").alias("p")), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "p")
    dealt = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    own = dealt.join(texts.select(F.col("class").alias("b"), F.col("text").alias("q")), "b")
    return own.join(copies, ["a", "salt"]).select("a", "b", "p", "q").mapInArrow(_confirm(width), "a long, b long")


def _sha(text: Column) -> Column:
    """What a class is known by."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))).cast("binary"), 256))


def _linked(docs: DataFrame, width: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sha, n_shingles) of each row, and of each class with words (sha, component_id, stays): a
    component has one class that stays, with a row of the component's smallest id."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _sha(F.col("text")).alias("sha"), ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    sets = materialise(text.mapInArrow(_signatures(width, bands * rows, RING), "doc_id long, sha binary, n_shingles long, sig array<int>"), "signatures")
    # A class: all rows with one lower-cased text. Empty sets stay alone.
    classes = sets.where("n_shingles > 0").groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    # The table is written once, so the numbers given here stay.
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("class", F.posexplode(F.array(*[F.xxhash64(F.lit(b), F.slice("sig", b * rows + 1, rows)) for b in range(bands)])).alias("band", "value"))
    shared = buckets.groupBy("band", "value").agg(F.min("class").alias("pivot"), F.max("class").alias("most")).where("pivot < most")
    members = materialise(buckets.join(shared.select("band", "value", "pivot"), ["band", "value"]).select("class", "pivot", "band", F.xxhash64("band", "value").alias("bucket")), "buckets")
    stars = materialise(members.where("class > pivot").select("class", "pivot").distinct(), "stars")
    wanted = members.select("class").distinct()
    # One text of each class: that of a row with its smallest id.
    asked = wanted.join(classes.select("class", "sha", "first_id"), "class").select("class", F.col("sha").alias("_sha"), "first_id")
    full = text.join(asked, (text["sha"] == asked["_sha"]) & text["doc_id"].eqNullSafe(asked["first_id"])).select("class", "text")
    full = materialise(full.dropDuplicates(["class"]), "texts")
    labels = wanted.select("class", F.col("class").alias("comp"))

    closest = stars.groupBy("class").agg(F.min("pivot").alias("pivot"))
    first = materialise(_compared(closest.select(F.col("pivot").alias("a"), F.col("class").alias("b")), full, width), "verified")
    labels = components(first, labels)
    others = stars.join(closest, ["class", "pivot"], "left_anti").select(F.col("pivot").alias("a"), F.col("class").alias("b"))
    apart_ = materialise(apart(others, labels), "apart")
    labels = components(materialise(_compared(apart_, full, width), "verified"), labels)
    # Step 3: buckets whose members are still in several components.
    placed = members.join(labels, "class").join(classes.select("class", "n_shingles"), "class")
    open_buckets = placed.groupBy("bucket").agg(F.min("comp").alias("c"), F.max("comp").alias("d"), F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("held")).where("c < d and members > 2")
    inside = placed.join(open_buckets.select("bucket", "members", "held"), "bucket").join(classes.select("class", "sig"), "class").join(full, "class")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.least(F.col("held") / BLOCK_SHINGLES, F.col("members")))).cast("int")
    kept = ["bucket", "band", "class", "comp", "n_shingles", "sig", "text"]
    cut = inside.select(*kept, blocks.alias("blocks"), F.pmod(F.xxhash64("class"), blocks).cast("int").alias("block"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    dealt = cut.select(*kept, "block", F.explode(pairs).alias("ij")).select("*", "ij.i", "ij.j").drop("ij")
    joining = dealt.groupBy("bucket", "i", "j").applyInArrow(_block_links(bands, width), "a long, b long")
    labels = components(materialise(joining, "verified"), labels)
    # A component is named by the smallest id of its classes.
    by_class = classes.join(labels, "class", "left").select("sha", "first_id", F.coalesce("comp", "class").alias("comp"))
    best = F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id", "sha"))
    ids = by_class.groupBy("comp").agg(best.alias("best")).select("comp", F.col("best.first_id").alias("component_id"), F.col("best.sha").alias("own"))
    return sets.drop("sig"), by_class.join(ids, "comp").select("sha", "component_id", (F.col("sha") == F.col("own")).alias("stays"))


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs.

    Shingles are runs of `width` words of lower-cased text; a shorter text is one shingle, and a text
    without words (or null) has none and is linked with nothing. Rows are linked at similarity 0.75
    or more; component_id is the smallest id reachable. Repeated rows are linked and share their
    component; all with the component's id are kept. An id may stand on rows with different texts: each row
    is linked by its own text. A null id is no smallest id unless there is no other: then component_id is null
    and the row is kept. Other columns are ignored; an empty table gives an empty result.
    """
    sets, linked = _linked(docs, width, bands, rows)
    joined = sets.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("sha")).alias("sha")).join(linked, "sha", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose classes are in different components so far."""
    x = labels.select(F.col("class").alias("a"), F.col("comp").alias("x"))
    y = labels.select(F.col("class").alias("b"), F.col("comp").alias("y"))
    return pairs.join(x, "a").join(y, "b").where("x <> y").select("a", "b")


def apply_near_dedup(docs: DataFrame, *, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of docs that stay, with their columns: one of each component, and every row without words.

    A component's row has its smallest id (null only where all are null), and the least of its texts by SHA-256 where that id stands on
    several; of repeated rows one stays. Rows without words are told apart by id and text.
    """
    _, linked = _linked(docs, width, bands, rows)
    staying = linked.where("stays").select(F.col("sha").alias("_kept_sha"), F.col("component_id").alias("_kept_id"))
    same = (_sha(docs["text"]) == staying["_kept_sha"]) & docs["doc_id"].cast("long").eqNullSafe(staying["_kept_id"])
    # Repeated rows may differ in case and columns; the lower-cased text and the id make them one.
    kept = docs.join(staying, same, "left_semi").unionByName(docs.where(~F.coalesce(docs["text"].cast("string"), F.lit("")).rlike(WORD)))
    name = free_name(docs.columns, "_class")
    return kept.withColumn(name, F.struct(_sha(F.col("text")), F.col("text").isNull())).dropDuplicates(["doc_id", name]).drop(name)
