"""Merkle manifest of a data set: a tree of digests per source, and one over the sources' roots.

Inner nodes have three children. The leaves of a tree, in order, are dealt into aligned blocks of 3^7; a block's subtree is
stored as one array of digests in van Emde Boas layout: the tree is cut at half its height, the top part comes
first and the bottom parts follow from left to right, each laid out the same way. Where a node lies is arithmetic
(`addresses`), for building as for fetching the siblings of a path, and nodes that are near in the tree are near in the array
at every scale. The blocks' roots are the leaves of the next round, until a tree is one block; the roots of the sources'
trees are the leaves of one more tree, built the same way.

Ranks come from a range sort that is written down once, with running counts per range; no tree, no source and no list
of siblings is ever in one task or on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_residue, materialise

FAN = 3
#: Levels of a block below its root: 2,187 leaves.
HEIGHT = 7
#: Leaves that a range of the sort should hold.
RANGE_ROWS = 250_000
DIGEST = 32


def size_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes `index` of the level `depth` (0: the root) lie in the layout of a complete tree of `levels` levels."""
    at = np.zeros(len(index), np.int64)
    index = np.asarray(index, np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below, wide = levels - top, FAN ** (depth - top)
        at += size_of(top) + index // wide * size_of(below)
        index, depth, levels = index % wide, depth - top, below
    return at


class Block:
    """An aligned subtree over `leaves` leaves, stored in one array of digests."""

    def __init__(self, leaves: int, height: int, nodes: np.ndarray | None = None):
        self.height = height
        #: Nodes of each level that exist, from the leaves up: the last run of a level may be short.
        self.counts = [leaves]
        for _ in range(height):
            self.counts.append(-(-self.counts[-1] // FAN))
        self.nodes = np.zeros((size_of(height + 1), DIGEST), np.uint8) if nodes is None else nodes

    def where(self, level: int, index: np.ndarray) -> np.ndarray:
        return addresses(self.height + 1, self.height - level, index)

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Block:
        block = cls(len(leaves), height)
        level = leaves
        for k in range(height + 1):
            block.nodes[block.where(k, np.arange(len(level)))] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
            if k < height:
                text = [d.hex() for d in level]
                level = [node_digest("".join(text[i : i + FAN])) for i in range(0, len(text), FAN)]
        return block

    @property
    def root(self) -> bytes:
        return self.nodes[self.where(self.height, np.zeros(1, int))[0]].tobytes()

    @classmethod
    def of(cls, row: dict) -> Block:
        """From a row of the manifest."""
        return cls(row["block_leaves"], row["height"], np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST))

    def leaves(self) -> list[bytes]:
        packed = self.nodes[self.where(0, np.arange(self.counts[0]))].tobytes()
        return [packed[i : i + DIGEST] for i in range(0, len(packed), DIGEST)]

    def siblings(self) -> list[list[tuple[str, str]]]:
        """For each leaf, level by level: the digests (as hex text) of its run's members before and after it."""
        text = [self.nodes[self.where(k, np.arange(n))].tobytes().hex() for k, n in enumerate(self.counts[:-1])]
        out = []
        for i in range(self.counts[0]):
            path = []
            for k, n in enumerate(self.counts[:-1]):
                first, end = i - i % FAN, min(i - i % FAN + FAN, n)
                path.append((text[k][2 * DIGEST * first : 2 * DIGEST * i], text[k][2 * DIGEST * (i + 1) : 2 * DIGEST * end]))
                i //= FAN
            out.append(path)
        return out


def node_digest(children: str) -> bytes:
    return hashlib.sha256(children.encode()).digest()


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = hashlib.sha256((before + digest + after).encode()).hexdigest()
    return digest


def ranked(rows: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """rows with rank (from 0) in its tree and leaves (of the tree), written down. Nulls come first."""
    n = rows.count()
    keys = [F.col(c).asc_nulls_first() for c in (*tree, *order)]
    ranges = max(1, -(-n // RANGE_ROWS))
    schema = rows.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("place")).schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, count = TaskContext.get().partitionId(), None, 0
        for b in batches:
            place = np.empty(b.num_rows, np.int64)
            if b.num_rows:
                # Rows of one tree are adjacent: where a tree begins the count starts anew.
                key = list(zip(*(b.column(c).to_pylist() for c in tree))) if tree else [()] * b.num_rows
                for i, k in enumerate(key):
                    if k != last:
                        last, count = k, 0
                    place[i] = count
                    count += 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(place)], schema.names)

    placed = materialise(rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).mapInArrow(number, schema), "merkle-leaves")
    counts = placed.groupBy(*tree, "part").agg(F.count(F.lit(1)).alias("n"))
    # A row for each range that a tree meets: a range holds RANGE_ROWS leaves.
    whole = Window.partitionBy(*tree)
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*[F.col(c).alias(f"_{c}") for c in tree], F.col("part").alias("_part"), before.alias("_before"), F.sum("n").over(whole).alias("leaves"))
    same = F.col("part") == F.col("_part")
    for c in tree:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(starts, same).withColumn("rank", F.col("place") + F.col("_before")).drop("part", "place", "_part", "_before", *[f"_{c}" for c in tree])


def blocks(leaves: DataFrame, tree: list[str], carried: list[str]) -> DataFrame:
    """One row per block: tree, block, block_leaves, height, more (the tree goes on above it), nodes (binary, the layout),
    root (binary) and the carried columns as arrays in leaf order. leaves: tree, rank, leaves, digest (binary) and carried."""
    keyed = leaves.withColumn("block", F.floor(F.col("rank") / FAN**HEIGHT).cast("long"))
    keep = [*tree, "block", "rank", "leaves", "digest", *carried]
    kinds = dict(leaves.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in tree] + ["block long, block_leaves int, height int, more boolean, nodes binary, root binary"] + [f"`{c}` array<{kinds[c]}>" for c in carried])

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        n = rows.column("leaves")[0].as_py()
        height = 0
        while height < HEIGHT and FAN**height < n:
            height += 1
        block = Block.build(rows.column("digest").to_pylist(), height)
        one = {c: [rows.column(c)[0].as_py()] for c in (*tree, "block")}
        one |= {"block_leaves": pa.array([rows.num_rows], pa.int32()), "height": pa.array([height], pa.int32()), "more": [FAN**HEIGHT < n], "nodes": [block.nodes.tobytes()], "root": [block.root]}
        carry = {c: pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(c).combine_chunks()) for c in carried}
        types = {c: rows.schema.field(c).type for c in tree}
        return pa.table({k: pa.array(v, types[k]) if k in types else v for k, v in (one | carry).items()})

    return keyed.select(*keep).groupBy(*tree, "block").applyInArrow(build, schema)


def forest(leaves: DataFrame, tree: list[str], order: list[str], carried: list[str]) -> list[DataFrame]:
    """The manifest: the blocks of each round, from the leaves up; in the last round every tree is one block.
    leaves: tree, order, digest (binary) and carried columns."""
    rounds = [materialise(blocks(ranked(leaves, tree, order), tree, carried), "merkle-blocks")]
    while not rounds[-1].where("more").isEmpty():
        up = rounds[-1].where("more")
        whole = Window.partitionBy(*tree)
        # A row per block: a tree of 2,187 blocks at a time becomes one.
        roots = up.select(*tree, F.col("block").alias("rank"), F.col("root").alias("digest")).withColumn("leaves", F.count(F.lit(1)).over(whole))
        rounds.append(materialise(blocks(roots, tree, []), "merkle-blocks"))
    return rounds


_PATH = "array<struct<before:string,after:string>>"


def _spread(level: DataFrame, tree: list[str]) -> DataFrame:
    """For each leaf of the blocks of level (with path, subroot, root) where it is (tree, of) and its own path upwards."""
    kinds = dict(level.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in tree] + [f"of long, path {_PATH}, subroot binary, root binary"])
    arrow_path = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):  # a block at a time
                r = b.slice(at, 1).to_pylist()[0]
                over = [(p["before"], p["after"]) for p in r["path"]]
                paths = Block.of(r).siblings()
                n, first = len(paths), r["block"] * FAN**HEIGHT
                columns = {c: pa.array([r[c]] * n, b.schema.field(c).type) for c in tree}
                columns |= {"of": pa.array(range(first, first + n), pa.int64()), "path": pa.array([[{"before": x, "after": y} for x, y in (*p, *over)] for p in paths], arrow_path)}
                columns |= {c: pa.array([r[c]] * n, pa.binary()) for c in ("subroot", "root")}
                yield pa.RecordBatch.from_pydict(columns)

    return level.select(*tree, "block", "block_leaves", "height", "nodes", "path", "subroot", "root").mapInArrow(run, schema)


def with_paths(rounds: list[DataFrame], tree: list[str], over: DataFrame | None = None) -> DataFrame:
    """The blocks of the first round with path (siblings of the block's root up to the last root), subroot (their tree's root) and
    root. over: tree, path and root above each tree; without it a tree's root is the last one.

    From the top down; every join is on (tree, block), of which each is there once, so no tree is hot.
    """
    ends = None if over is None else over.select(*tree, F.lit(False).alias("more"), F.lit(0).cast("long").alias("of"), "path", F.lit(None).cast("binary").alias("subroot"), "root")
    above = ends
    for level in reversed(rounds):
        plain = level.withColumnRenamed("root", "own")
        if above is None:
            found = plain.select("*", F.array().cast(_PATH).alias("path"), F.col("own").alias("subroot"), F.col("own").alias("root"))
        else:
            on = (F.col("a.more") == F.col("b.more")) & (F.col("a.block") == F.col("b.of"))
            for c in tree:
                on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
            met = plain.alias("a").join(above.alias("b"), on, "left")
            found = met.select("a.*", F.coalesce("b.path", F.array().cast(_PATH)).alias("path"), F.coalesce("b.subroot", "a.own").alias("subroot"), F.coalesce("b.root", "a.own").alias("root"))
        below = _spread(found, tree).withColumn("more", F.lit(True))
        above = below if ends is None else ends.unionByName(below)
    return found


def field_text(value: Column) -> Column:
    """A value in a leaf: its UTF-8 length, a colon and itself; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field_text, fields)).cast("binary"), 256))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verify(docs: DataFrame, altered: dict[str, Column] | None = None, *, fields: tuple[str, ...] = FIELDS, tree_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    altered: what columns of a row read as when it is checked (a null row-wise result is a null value). A null field is `-`. Leaves of a tree ascend
    by id, null first, rows of one id by their digests, so repeated rows are leaves each and their order makes no
    difference. A null tree is a tree of its own and the first one. With one tree, its root is the root. Other columns are
    ignored; an empty table gives an empty result.
    """
    tree, now = ["tree"], altered or {}
    text = {c: F.col(c) for c in fields}
    read = docs.select(
        F.col(tree_col).alias("tree"), F.col(id_col).alias("doc_id"), leaf_digest(list(text.values())).alias("digest"), leaf_digest([now.get(c, v) for c, v in text.items()]).alias("altered"))
    # The texts are read once, for both digests.
    leaves = materialise(read.withColumn("altered", F.nullif("altered", "digest")), "merkle-digests")
    rounds = forest(leaves, tree, ["doc_id", "digest"], ["doc_id", "altered"])
    subroots = [r.where("not more").select("tree", F.col("root").alias("digest")) for r in rounds]
    above = with_paths(forest(reduce(DataFrame.unionByName, subroots), [], ["tree"], ["tree"]), [])
    return _judged(with_paths(rounds, tree, _spread_roots(above)), docs.schema[id_col].dataType.simpleString())


def _spread_roots(blocks_of_roots: DataFrame) -> DataFrame:
    """tree, path, root of each leaf of the tree over the trees' roots."""
    places = blocks_of_roots.select(F.posexplode("tree").alias("k", "tree"), (F.col("block") * FAN**HEIGHT).alias("first")).select("tree", (F.col("first") + F.col("k")).alias("at"))
    return places.join(_spread(blocks_of_roots, []), F.col("at") == F.col("of")).select("tree", "path", "root")


def _judged(found: DataFrame, id_kind: str) -> DataFrame:
    schema = f"doc_id {id_kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):  # a block at a time
                one = b.slice(at, 1)
                r = one.to_pylist()[0]
                block, over, root, subroot = Block.of(r), [(p["before"], p["after"]) for p in r["path"]], r["root"].hex(), r["subroot"].hex()
                n, leaf, proof, folded = r["block_leaves"], [], [], []
                rest = "".join(x + y for x, y in over)
                for own, changed, path in zip(block.leaves(), r["altered"], block.siblings()):
                    leaf.append(own.hex())
                    proof.append(hashlib.sha256(("".join(x + y for x, y in path) + rest).encode()).hexdigest())
                    folded.append(fold((changed or own).hex(), [*path, *over]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": one.column(one.schema.get_field_index("doc_id"))[0].values, "leaf": leaf, "subroot": [subroot] * n, "root": [root] * n,
                    "proof_sha256": proof, "folded_root": folded, "verified": [f == root for f in folded],
                })

    return found.select("block_leaves", "height", "nodes", "path", "subroot", "root", "doc_id", "altered").mapInArrow(run, schema)


def tamper_newlines(doc_id: Column, text: Column) -> Column:
    """The text without its line feeds where 2 divides crc32 of the id's decimal text; a null id counts as empty text."""
    return F.when(id_residue(doc_id, 2) == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


#: DuckDB SQL for the query. crc32 goes byte by byte through a table of 256 remainders.
ORACLE = """
WITH RECURSIVE entries AS (
  SELECT 0 AS step, i AS k, i AS c FROM range(256) r(i)
  UNION ALL SELECT step + 1, k, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM entries WHERE step < 8),
crc AS (SELECT list(c ORDER BY k) AS tab FROM entries WHERE step = 8),
d AS (SELECT doc_id, source, lang, n_chars, text, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295::BIGINT) % 2 = 0 AS hit FROM documents, crc),
e AS (SELECT *, CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END AS altered FROM d),
h AS (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS other FROM (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM e)),
trees AS (
  SELECT source, 0 AS level, i, n, leaf AS digest FROM h
  UNION ALL SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM trees WHERE n > 1 GROUP BY source, level, i // 3, n),
subroots AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM trees WHERE n = 1),
top AS (
  SELECT 0 AS level, i, n, subroot AS digest FROM subroots
  UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n),
runs AS (SELECT source, level, i // 3 AS run, list(digest ORDER BY i) AS members FROM trees WHERE n > 1 GROUP BY 1, 2, 3),
top_runs AS (SELECT level, i // 3 AS run, list(digest ORDER BY i) AS members FROM top WHERE n > 1 GROUP BY 1, 2),
below AS (
  SELECT doc_id, source, 0 AS level, i, n, CASE WHEN hit THEN other ELSE leaf END AS folded, '' AS proof FROM h
  UNION ALL SELECT doc_id, b.source, b.level + 1, i // 3, (n + 2) // 3,
    sha256(array_to_string(members[:(i % 3)::INT], '') || folded || array_to_string(members[(i % 3 + 2)::INT:], '')), proof || array_to_string(members[:(i % 3)::INT], '') || array_to_string(members[(i % 3 + 2)::INT:], '')
  FROM below b JOIN runs r ON b.source IS NOT DISTINCT FROM r.source AND b.level = r.level AND b.i // 3 = r.run WHERE n > 1),
above AS (
  SELECT doc_id, 0 AS level, s.i, s.n, folded, proof FROM below b JOIN subroots s ON b.source IS NOT DISTINCT FROM s.source WHERE b.n = 1
  UNION ALL SELECT doc_id, a.level + 1, i // 3, (n + 2) // 3,
    sha256(array_to_string(members[:(i % 3)::INT], '') || folded || array_to_string(members[(i % 3 + 2)::INT:], '')), proof || array_to_string(members[:(i % 3)::INT], '') || array_to_string(members[(i % 3 + 2)::INT:], '')
  FROM above a JOIN top_runs r ON a.level = r.level AND a.i // 3 = r.run WHERE n > 1)
SELECT h.doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM h JOIN above a ON h.doc_id = a.doc_id AND a.n = 1 JOIN subroots s ON h.source IS NOT DISTINCT FROM s.source JOIN top t ON t.n = 1
"""
