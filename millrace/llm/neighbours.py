"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beams.

Vectors are dealt by a hash of their id to shards of bounded size. In a shard, equal vectors become one node.
The graph grows in batches: greedy searches on the graph so far propose neighbours for each new node, and
relaxed distance pruning keeps diverse edges, also in the reverse direction. Each query's beam then walks the
graph of every shard, and the shards' best are merged. A shard is built when its vectors have streamed in and
dropped when its queries have streamed past, so a task holds one shard and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 6_000
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 128
RELAXATION = 1.2
STARTS = 24
BATCH = 256


class Graph:
    """The graph of one shard over distinct vectors; ``edges`` has -1 where a node has fewer neighbours."""

    def __init__(self, vectors: np.ndarray, seed: int = 0):
        self.x = vectors.astype(np.float32)
        self.norm = np.einsum("ij,ij->i", self.x, self.x)
        n = len(self.x)
        rng = np.random.default_rng(seed)
        self.starts = np.sort(rng.choice(n, min(STARTS, n), replace=False))
        self.edges = np.full((n, DEGREE), -1, np.int64)
        order = rng.permutation(n)
        # A small core is linked completely; later nodes find their neighbours by search.
        core = np.union1d(order[:DEGREE], self.starts)[: DEGREE + STARTS]
        for node in core:
            near = core[core != node][:DEGREE]
            self.edges[node, : len(near)] = near
        rest = order[~np.isin(order, core)]
        at, size = 0, 32
        while at < len(rest):
            self._add(rest[at : at + size])
            at, size = at + size, min(size * 2, BATCH)
        for start in range(0, n, BATCH):
            self._add(order[start : start + BATCH])

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its row of nodes; infinite for -1."""
        dots = (self.x[nodes] @ queries[:, :, None])[:, :, 0]
        out = self.norm[nodes] - 2 * dots + np.einsum("bd,bd->b", queries, queries)[:, None]
        return np.where(nodes < 0, np.inf, np.maximum(out, 0))

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes that a beam search finds for each query (-1: fewer), and their squared distances."""
        b, n = len(queries), len(self.x)
        seen = np.zeros((b, n + 1), bool)  # the last column is for -1
        seen[:, n] = True
        nodes = np.full((b, width), -1, np.int64)
        first = self.starts[:width]
        nodes[:, : len(first)] = first
        seen[:, first] = True
        away = self.distances(queries, nodes)
        open_ = nodes >= 0
        while True:
            wait = np.where(open_, away, np.inf)
            pick = wait.argmin(axis=1)
            todo = np.flatnonzero(np.isfinite(wait[np.arange(b), pick]))
            if not len(todo):
                return nodes, away
            open_[todo, pick[todo]] = False
            near = self.edges[nodes[todo, pick[todo]]]
            near = np.where(seen[todo[:, None], near], -1, near)
            seen[todo[:, None], near] = True
            new = self.distances(queries[todo], near)
            all_nodes = np.concatenate([nodes[todo], near], axis=1)
            all_away = np.concatenate([away[todo], new], axis=1)
            all_open = np.concatenate([open_[todo], near >= 0], axis=1)
            best = np.argpartition(all_away, width - 1, axis=1)[:, :width]
            at = np.arange(len(todo))[:, None]
            nodes[todo], away[todo] = all_nodes[at, best], all_away[at, best]
            open_[todo] = all_open[at, best] & np.isfinite(away[todo])

    def prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """For each node at most DEGREE diverse candidates: one is dropped if a kept one is nearer to it by far."""
        candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        away = self.distances(self.x[nodes], candidates)
        if candidates.shape[1] > 4 * DEGREE:
            best = np.argpartition(away, 4 * DEGREE - 1, axis=1)[:, : 4 * DEGREE]
            candidates, away = np.take_along_axis(candidates, best, 1), np.take_along_axis(away, best, 1)
        points = self.x[candidates]
        between = points @ points.transpose(0, 2, 1)
        squares = self.norm[candidates]
        between = squares[:, :, None] + squares[:, None, :] - 2 * between
        alive = np.where(candidates < 0, np.inf, away)
        out = np.full((len(nodes), DEGREE), -1, np.int64)
        line = np.arange(len(nodes))
        for k in range(DEGREE):
            pick = alive.argmin(axis=1)
            some = np.isfinite(alive[line, pick])
            if not some.any():
                break
            out[some, k] = candidates[line[some], pick[some]]
            covered = RELAXATION**2 * between[line, pick] <= away
            alive[covered & some[:, None]] = np.inf
            alive[line, pick] = np.inf
        return out

    def _add(self, nodes: np.ndarray) -> None:
        found, _ = self.beam(self.x[nodes], BUILD_BEAM)
        self.edges[nodes] = self.prune(nodes, np.concatenate([found, self.edges[nodes]], axis=1))
        source = np.repeat(nodes, DEGREE)
        target = self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, count = np.unique(target, return_index=True, return_counts=True)
        # Hubs are worked on apart, so that their long lists don't widen the others'.
        for low, high in ((0, 8), (8, 32), (32, 10**9)):
            part = np.flatnonzero((count > low) & (count <= high))
            for start in range(0, len(part), BATCH):
                own = part[start : start + BATCH]
                width = count[own].max()
                more = np.full((len(own), width), -1, np.int64)
                for line, k in enumerate(own):
                    more[line, : count[k]] = source[first[k] : first[k] + count[k]]
                self.edges[heads[own]] = self.prune(heads[own], np.concatenate([self.edges[heads[own]], more], axis=1))


class Shard:
    """The distinct vectors of a shard with the ids that share them, and their graph."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.vectors, node = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, node.ravel()))
        self.ids = ids[order]
        self.first = np.searchsorted(node.ravel()[order], np.arange(len(self.vectors) + 1))
        self.graph = Graph(self.vectors)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id, distance of the nearest ``k`` found for each query; equal distances by id."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(0, len(queries), BATCH):
            part, own = queries[start : start + BATCH], query_ids[start : start + BATCH]
            found, _ = self.graph.beam(part.astype(np.float32), SEARCH_BEAM)
            for query, own_id, nodes in zip(part, own, found, strict=True):
                nodes = nodes[nodes >= 0]
                away = np.sqrt(((self.vectors[nodes] - query) ** 2).sum(axis=1))
                # Of ids with one vector, k + 1 suffice: ties go to the smaller, one may be the query.
                ids = [self.ids[self.first[n] : min(self.first[n + 1], self.first[n] + k + 1)] for n in nodes]
                away = np.repeat(away, [len(i) for i in ids])
                ids = np.concatenate(ids) if len(ids) else np.empty(0, np.int64)
                away, ids = away[ids != own_id], ids[ids != own_id]
                best = np.lexsort((ids, away))[:k]
                out.append((np.full(len(best), own_id), ids[best], away[best]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors found for each query.

    Both tables have ``vec_id`` and ``embedding``. ``score`` is the Euclidean distance in double precision;
    equal distances rank by id. Unusable vectors and null ids take no part, neither do vectors of another
    length than the query's, nor the query's own id. Repeated rows are candidates each; a query id that
    repeats is asked once, with its smallest vector. Fewer than ``k`` candidates give fewer rows.
    """
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")]
    base = vectors.select(*columns).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    asked = queries.select(*columns).where(F.col("vec_id").isNotNull() & usable(F.col("v"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    shards = max(1, -(-base.count() // shard_rows))
    base = base.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("role"), "vec_id", "v")
    asked = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("role"), "vec_id", "v")
    # A shard holds about ``shard_rows`` vectors, whatever their values are.
    dealt = base.unionByName(asked).select(F.size("v").alias("length"), "*")
    # A shard is few bytes and much work: a partition of its own, where hashed shards would share some and leave others empty.
    dealt = dealt.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("length", "shard", "role", "vec_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_key, waiting, shard = None, [], None
        for batch in batches:
            length, number, role = (batch.column(c).to_numpy() for c in range(3))
            ids = batch.column(3).to_numpy()
            edges = np.flatnonzero((np.diff(length) != 0) | (np.diff(number) != 0) | (np.diff(role) != 0)) + 1
            for low, high in zip([0, *edges], [*edges, len(ids)], strict=True):
                if high == low:
                    continue
                if (length[low], number[low]) != shard_key:
                    shard_key, waiting, shard = (length[low], number[low]), [], None
                lists = batch.column(4).slice(low, high - low)
                rows = lists.flatten().to_numpy().reshape(high - low, -1)
                if role[low] == 0:
                    waiting.append((ids[low:high], rows))
                    continue
                if shard is None and waiting:
                    shard, waiting = Shard(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])), []
                if shard is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in shard.search(ids[low:high], rows, k)], ["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(work, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
