"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one point with its smallest ids (as many as an answer can hold). Points of one order of magnitude are
dealt by hash into shards of bounded size; a task builds a shard's graph and stores it as flat arrays: one
row of vectors, neighbour lists and ids. Blocks of queries meet every shard's row, and the shards'
answers are merged by a rank per query. Largest inner product becomes nearest neighbour by one more
coordinate, sqrt(M^2 - |x|^2) with M the largest norm of the shard, which is 0 for queries. Graphs are walked in
single precision on vectors scaled by the shard's largest component; scores are those of the original vectors, in double precision.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

NEIGHBOURS = 16
EF_BUILD, EF_SEARCH = 72, 320
SHARD_ROWS = 1 << 14
BLOCK = 2048
K = 20


class Graph:
    """Flat arrays: base (points, 2M) and, for each upper layer, (points of it, M); -1 pads."""

    def __init__(self, points: np.ndarray, m: int = NEIGHBOURS):
        self.points, self.m = points, m
        self.base = np.full((len(points), 2 * m), -1, np.int32)
        self.upper: list[dict[int, np.ndarray]] = []
        self.entry = 0

    def search(self, q: np.ndarray, entries: list[tuple[float, int]], ef: int, layer: int, seen: np.ndarray, mark: int) -> list[tuple[float, int]]:
        """The ef best (inner product, node) found from the entries, best first."""
        best = list(entries)
        heapq.heapify(best)
        open_ = [(-s, n) for s, n in entries]
        heapq.heapify(open_)
        for _, n in entries:
            seen[n] = mark
        points, base = self.points, self.base
        while open_:
            s, node = heapq.heappop(open_)
            if -s < best[0][0] and len(best) >= ef:
                break
            near = base[node] if layer == 0 else self.upper[layer - 1][node]
            near = near[(near >= 0) & (seen[near] != mark)]
            if not len(near):
                continue
            seen[near] = mark
            scores = points[near] @ q
            if len(best) >= ef:
                ok = scores > best[0][0]
                near, scores = near[ok], scores[ok]
            for v, n in zip(scores.tolist(), near.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (v, n))
                    heapq.heappush(open_, (-v, n))
                elif v > best[0][0]:
                    heapq.heapreplace(best, (v, n))
                    heapq.heappush(open_, (-v, n))
        return sorted(best, reverse=True)

    def spread(self, nodes: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Nodes, best first, that are nearer to the point than to a node already chosen; then the rest."""
        if len(nodes) <= most:
            return nodes
        between = self.points[nodes] @ self.points[nodes].T
        chosen, passed = [], []
        nearest = np.full(len(nodes), -np.inf, np.float32)
        for i in range(len(nodes)):
            if nearest[i] < scores[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.maximum(nearest, between[i], out=nearest)
            else:
                passed.append(i)
        return nodes[[*chosen, *passed[: most - len(chosen)]]]

    def build(self, ef: int, seed: int = 9) -> Graph:
        n = len(self.points)
        levels = (-np.log(np.random.default_rng(seed).random(n)) / math.log(self.m)).astype(int) if n else []
        seen, top = np.full(n, -1, np.int64), -1
        for node in range(n):
            q, level = self.points[node], int(levels[node])
            if top < 0:
                self.upper, self.entry, top = [{node: np.full(self.m, -1, np.int32)} for _ in range(level)], node, level
                continue
            found = [(float(self.points[self.entry] @ q), self.entry)]
            for layer in range(top, level, -1):
                found = self.search(q, found[:1], 1, layer, seen, node * 64 + layer)
            for layer in range(min(level, top), -1, -1):
                found = self.search(q, found, ef, layer, seen, node * 64 + layer)
                most = 2 * self.m if layer == 0 else self.m
                own = self.spread(np.array([x for _, x in found], np.int32), np.array([s for s, _ in found], np.float32), self.m)
                row = np.full(most, -1, np.int32)
                row[: len(own)] = own
                if layer == 0:
                    self.base[node] = row
                else:
                    self.upper[layer - 1][node] = row
                for other in own.tolist():
                    there = self.base[other] if layer == 0 else self.upper[layer - 1][other]
                    if there[-1] < 0:
                        there[np.argmax(there < 0)] = node
                    else:
                        all_ = np.append(there, np.int32(node))
                        scores = self.points[all_] @ self.points[other]
                        by = np.argsort(-scores, kind="stable")
                        kept = self.spread(all_[by], scores[by], most)
                        there[:] = -1
                        there[: len(kept)] = kept
            for layer in range(top + 1, level + 1):
                self.upper.append({node: np.full(self.m, -1, np.int32)})
            if level > top:
                self.entry, top = node, level
        return self

    def query(self, q: np.ndarray, k: int, ef: int, seen: np.ndarray, mark: int) -> list[int]:
        found = [(float(self.points[self.entry] @ q), self.entry)]
        for layer in range(len(self.upper), 0, -1):
            found = self.search(q, found[:1], 1, layer, seen, mark * 64 + layer)
        return [n for _, n in self.search(q, found, max(ef, k), 0, seen, mark * 64)[:k]]

    def flat(self) -> bytes:
        """Upper layers as one int32 array: layers, then per layer its size and (node, neighbours) rows."""
        parts = [np.array([self.entry, len(self.upper)], np.int32)]
        for layer in self.upper:
            parts.append(np.array([len(layer)], np.int32))
            parts += [np.concatenate([[n], row]).astype(np.int32) for n, row in layer.items()]
        return np.concatenate(parts).tobytes()

    @classmethod
    def load(cls, points: np.ndarray, base: bytes, upper: bytes, m: int) -> Graph:
        self = cls(points, m)
        self.base = np.frombuffer(base, np.int32).reshape(len(points), 2 * m)
        flat = np.frombuffer(upper, np.int32)
        self.entry, at = int(flat[0]), 2
        for _ in range(int(flat[1])):
            size = int(flat[at])
            rows = flat[at + 1 : at + 1 + size * (m + 1)].reshape(size, m + 1)
            self.upper.append({int(r[0]): r[1:] for r in rows})
            at += 1 + size * (m + 1)
        return self


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _build(m: int, ef: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        table = table.sort_by([("first", "ascending")])
        x = _matrix(table.column("vector"), dim)
        graph = Graph(_lifted(x), m).build(ef)
        ids = table.column("ids").to_pylist()
        ends = np.cumsum([len(i) for i in ids])
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()),
            "vectors": pa.array([np.ascontiguousarray(x, np.float64).tobytes()], pa.binary()), "base": pa.array([graph.base.tobytes()], pa.binary()), "upper": pa.array([graph.flat()], pa.binary()),
            "ids": pa.array([np.array([i for own in ids for i in own], np.int64).tobytes()], pa.binary()), "ends": pa.array([ends.astype(np.int64).tobytes()], pa.binary()),
        })

    return run


def _lifted(x: np.ndarray) -> np.ndarray:
    """Vectors of about one length, scaled to components of 1 at most, with the coordinate that makes them equally long."""
    x = x / np.abs(x).max()
    squares = (x**2).sum(1)
    return np.column_stack([x, np.sqrt(squares.max() - squares)]).astype(np.float32)


def _ask(k: int, m: int, ef: int):
    def run(key: tuple[pa.Scalar, ...], graphs: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if graphs.num_rows and queries.num_rows:
            g, dim = graphs.to_pylist()[0], key[0].as_py()
            x = np.frombuffer(g["vectors"], np.float64).reshape(-1, dim)
            graph = Graph.load(_lifted(x), g["base"], g["upper"], m)
            ids, ends = np.frombuffer(g["ids"], np.int64), np.frombuffer(g["ends"], np.int64)
            asked = _matrix(queries.column("vector"), dim).astype(np.float64)
            seen = np.full(len(x), -1, np.int64)
            for r, (query, q) in enumerate(zip(queries.column("query_id").to_pylist(), asked)):
                found = graph.query(np.append(q / np.abs(q).max(), 0).astype(np.float32), k + 1, ef, seen, r)
                scores = x[found] @ q
                here = []
                for n, s in zip(found, scores.tolist()):
                    here += [(-s, i) for i in ids[ends[n - 1] if n else 0 : ends[n]].tolist() if i != query]
                for s, i in sorted(here)[:k]:
                    out[0].append(query)
                    out[1].append(i)
                    out[2].append(-s)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return run


def nearest(embeddings: DataFrame, *, k: int = K, every: int = 20, m: int = NEIGHBOURS, ef_build: int = EF_BUILD, ef_search: int = EF_SEARCH, shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k nearest others.

    Vectors that are null, empty, all zero or hold a null or a non-finite component take no part,
    neither do null ids; vectors are searched among those of their own length. Repeated rows are one
    candidate and one query; an id with several vectors has the least of them. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where("vec_id is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & F.exists("vector", lambda x: x != 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    points = rows.withColumn("rn", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("rn") <= k + 1)
    points = materialise(points.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "points")
    # Shards hold vectors within a factor of 256, so that single precision tells all of them apart.
    band = F.floor(F.log2(F.array_max(F.transform("vector", F.abs))) / 8).cast("long")
    sizes = points.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).select("band", F.ceil(F.col("n") / shard_rows).cast("long").alias("parts"))
    # At most 262 bands: a double's exponents by eights.
    parts = {r["band"]: (at, r["parts"]) for r, at in _running(sizes.orderBy("band").collect())}
    shards = sum(n for _, n in parts.values())
    first = F.create_map(*[F.lit(v) for b, (at, _) in parts.items() for v in (b, at)]) if parts else F.create_map(F.lit(0), F.lit(0))
    count = F.create_map(*[F.lit(v) for b, (_, n) in parts.items() for v in (b, n)]) if parts else F.create_map(F.lit(0), F.lit(1))
    shard = (F.element_at(first, band) + F.pmod(F.xxhash64("vector"), F.element_at(count, band))).cast("long")
    dealt = points.select(F.size("vector").alias("dim"), shard.alias("shard"), "vector", "ids", F.element_at("ids", 1).alias("first"))
    schema = "dim int, shard long, vectors binary, base binary, upper binary, ids binary, ends binary"
    graphs = materialise(dealt.groupBy("dim", "shard").applyInArrow(_build(m, ef_build), schema), "graphs")
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    queries = asked.select(F.size("vector").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, shards) - 1).cast("long"))).alias("shard"), block.alias("block"), F.col("vec_id").alias("query_id"), "vector")
    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_ask(k, m, ef_search), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _running(rows: list) -> list[tuple]:
    """Rows with the sum of the parts before each."""
    out, at = [], 0
    for r in rows:
        out.append((r, at))
        at += r["parts"]
    return out
