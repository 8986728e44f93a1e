"""Ranked lexical search: document FP-trees searched depth first, with bounds, per query item.

Only the items' own terms can score, so each document is restricted to them: a vector of term and frequency, terms in
descending order of the number of documents that hold them. Vectors are dealt to shards of a bounded number of
entries. In a shard they are sorted, so that those with the same first terms stand together and share a path of
the shard's tree; a node is the range of documents under it and holds the largest frequency of every term and the
smallest length norm among them. No document below scores higher than a document of these maxima and this norm would. An
item's search goes down from the root, the more promising child first, and leaves a node whose bound can't reach the
ten best found so far. Leaves are scored exactly.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.decontaminate import normalised
from millrace.llm.text import by_batch
from millrace.session import scratch_path

#: Text of the items that one search holds; a larger set of items is searched block by block.
BLOCK_BYTES = 1 << 20
#: Term entries of one shard, and documents of a leaf of its tree.
SHARD_ENTRIES = 1_000_000
LEAF = 32


@dataclass
class Block:
    """Some items: their ids and terms (numbers in descending document frequency) and the terms' weights."""

    items: list[tuple[int, np.ndarray]]
    weights: np.ndarray


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def term_vectors(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, counts``: a text's number of terms, and its entries among the vocabulary's."""
    number = {term: i for i, term in enumerate(vocabulary)}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, terms, counts = [], [], []
        for text in batch.column(1).to_pylist():
            found = normalised((text or "").encode()).split()
            held = {number[t]: c for t, c in Counter(found).items() if t in number}
            sizes.append(len(found))
            terms.append(list(held))
            counts.append(list(held.values()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
            ["doc_id", "n", "terms", "counts"],
        )

    return by_batch(documents.select("doc_id", "text"), work, "doc_id long, n long, terms array<int>, counts array<long>")


def scores(weights: np.ndarray, counts: np.ndarray, norms: np.ndarray | int) -> np.ndarray:
    """What each entry adds to a document's score; grows with the count and falls with the norm."""
    return weights * (1_000_000_000 * counts // (1000 * counts + 8 * norms))


class Tree:
    """A shard's documents in the order of their vectors, and the nodes over ranges of them, parents first."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, first: np.ndarray, terms: np.ndarray, counts: np.ndarray, leaf: int = LEAF):
        text = terms.astype(">i4").tobytes()
        order = sorted(range(len(ids)), key=lambda d: text[4 * first[d] : 4 * first[d + 1]])
        self.ids, self.norms = ids[order], norms[order]
        sizes = np.diff(first)[order]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(first[:-1][order] - self.first[:-1], sizes) + np.arange(self.first[-1])
        self.terms, self.counts = terms[at], counts[at]
        #: (first document, end, shared terms) and the children of each node; none for a leaf.
        self.ranges = [(0, len(ids), 0)]
        self.children: list[list[int]] = []
        for low, high, depth in self.ranges:
            parts = self._parts(low, high, depth) if high - low > leaf else []
            parts = _packed(parts, leaf)
            self.children.append(list(range(len(self.ranges), len(self.ranges) + len(parts))))
            self.ranges.extend(parts)
        #: Per node: its terms, the largest count of each, and the least norm.
        self.most: list[tuple[np.ndarray, np.ndarray, int]] = [None] * len(self.ranges)
        for n in reversed(range(len(self.ranges))):
            low, high, _ = self.ranges[n]
            if own := [self.most[c] for c in self.children[n]]:
                terms, counts = (np.concatenate([m[i] for m in own]) for i in (0, 1))
            else:
                terms, counts = (x[self.first[low] : self.first[high]] for x in (self.terms, self.counts))
            names, owner = np.unique(terms, return_inverse=True)
            largest = np.zeros(len(names), np.int64)
            np.maximum.at(largest, owner, counts)
            self.most[n] = names, largest, int(self.norms[low:high].min())

    def _parts(self, low: int, high: int, depth: int) -> list[tuple[int, int, int]]:
        """The branches of documents that share ``depth`` terms, down from where their common path ends.

        Equal vectors, and a path that nearly all share, are halved: so no chain of nodes is longer than a few
        times the logarithm of its documents.
        """
        while True:
            places = self.first[low:high] + depth
            held = places < self.first[low + 1 : high + 1]
            step = np.where(held, self.terms[np.minimum(places, len(self.terms) - 1)], -1)
            if step[0] != step[-1] or step[0] < 0:
                break
            depth += 1
        edges = [low, *(np.flatnonzero(np.diff(step)) + low + 1).tolist(), high]
        if max(b - a for a, b in zip(edges, edges[1:])) > (high - low) * 3 // 4:
            middle = (low + high) // 2
            return [(low, middle, depth), (middle, high, depth)]
        return [(a, b, depth + 1) for a, b in zip(edges, edges[1:])]

    def bounds(self, weights: np.ndarray, terms: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Per node and item: no document under the node scores more.

        Items are given by their terms, run together, and where each one's begin.
        """
        out = np.empty((len(self.ranges), len(begin)), np.int64)
        dense = np.zeros(len(weights), np.int64)
        for n, (names, largest, norm) in enumerate(self.most):
            dense[names] = scores(weights[names], largest, norm)
            out[n] = np.add.reduceat(dense[terms], begin)
            dense[names] = 0
        return out

    def leaf_scores(self, n: int, weight: np.ndarray) -> np.ndarray:
        """The scores of a leaf's documents; ``weight`` is zero but at the item's terms."""
        low, high, _ = self.ranges[n]
        a, b = self.first[low], self.first[high]
        held = weight[self.terms[a:b]]
        some = np.flatnonzero(held)
        owner = np.searchsorted(self.first[low + 1 : high + 1] - a, some, side="right")
        total = np.zeros(high - low, np.int64)
        np.add.at(total, owner, scores(held[some], self.counts[a:b][some], self.norms[low:high][owner]))
        return total

    def search(self, bound: np.ndarray, weight: np.ndarray, k: int, best: list[tuple[int, int]]) -> int:
        """Adds the shard's documents to ``best``, a heap of at most ``k`` of ``(score, -doc_id)``; returns the leaves read."""
        waiting, read = [0], 0
        while waiting:
            n = waiting.pop()
            # At an equal score a smaller id still gets in.
            if not bound[n] or len(best) == k and bound[n] < best[0][0]:
                continue
            if self.children[n]:
                waiting.extend(sorted(self.children[n], key=bound.__getitem__))
                continue
            read += 1
            total = self.leaf_scores(n, weight)
            low = self.ranges[n][0]
            for d in np.flatnonzero(total if len(best) < k else total >= best[0][0]).tolist():
                found = (int(total[d]), -int(self.ids[low + d]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return read


def _packed(parts: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """Neighbouring branches of at most ``most`` documents together are one leaf."""
    out: list[tuple[int, int, int]] = []
    for low, high, depth in parts:
        if out and high - out[-1][0] <= most:
            out[-1] = (out[-1][0], high, depth)
        else:
            out.append((low, high, depth))
    return out


def _searched(block: Block, n_docs: int, n_terms: int, k: int, most: int, leaf: int):
    """Per task: trees of at most ``most`` entries, one after the other; the k best per item go on from tree to tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in block.items]
        all_terms = np.concatenate([terms for _, terms in block.items])
        begin = np.cumsum([0] + [len(terms) for _, terms in block.items[:-1]])
        waiting: list[pa.RecordBatch] = []
        entries = 0

        def finish() -> None:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            lists = rows.column("terms").combine_chunks(), rows.column("counts").combine_chunks()
            first = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            n = rows.column("n").to_pylist()
            norms = np.array([10 + 90 * size * n_docs // n_terms for size in n], np.int64)
            tree = Tree(rows.column("doc_id").to_numpy(), norms, first, *(c.flatten().to_numpy() for c in lists), leaf)
            bounds = tree.bounds(block.weights, all_terms, begin)
            weight = np.zeros(len(block.weights), np.int64)
            for i, ((_, terms), found) in enumerate(zip(block.items, best, strict=True)):
                weight[terms] = block.weights[terms]
                tree.search(bounds[:, i].tolist(), weight, k, found)
                weight[terms] = 0

        for batch in batches:
            low = 0
            sizes = np.cumsum(batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            while low < batch.num_rows:
                # A document of more entries than a tree may have is a tree of its own.
                before = int(sizes[low - 1]) if low else 0
                high = max(int(np.searchsorted(sizes, before + most - entries, side="right")), low + (not waiting))
                if high > low:
                    waiting.append(batch.slice(low, high - low))
                    entries += int(sizes[high - 1]) - before
                if high < batch.num_rows:
                    finish()
                    waiting, entries = [], 0
                low = high
        if waiting:
            finish()
        rows = [(item, -d, s) for (item, _), found in zip(block.items, best, strict=True) for s, d in found]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return work


def _items(items: DataFrame, part: int, parts: int) -> dict[int, set[bytes]]:
    """The terms of each item of one block; an id that repeats has the terms of all its rows."""
    own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
    held: dict[int, set[bytes]] = {}
    for item, text in own.toLocalIterator():
        held.setdefault(item, set()).update(normalised(text.encode()).split())
    return held


def ranked(
    documents: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
    shard_entries: int = SHARD_ENTRIES,
    leaf: int = LEAF,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item, ties by ``doc_id``.

    ``items`` is the stated query set. It is measured and worked through in blocks of about ``block_bytes`` of
    text, so that the vocabulary a task holds is bounded; each block reads the documents once. Items without an id,
    text or term have no result. Each row of ``documents`` is a document: repeated rows are ranked each, after
    each other; rows without an id count in the statistics but can't be named and so aren't ranked. Null and
    empty texts hold no term. Empty tables give no rows.
    """
    spark = documents.sparkSession
    items = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // block_bytes))
    found = None
    for part in range(parts):
        own = _search_block(documents, _items(items, part, parts), k, shard_entries, leaf)
        if own is not None:
            found = own if found is None else found.unionByName(own)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(documents: DataFrame, held: dict[int, set[bytes]], k: int, shard_entries: int, leaf: int) -> DataFrame | None:
    vocabulary = sorted(set().union(*held.values()))
    if not vocabulary:
        return None
    vectors = _stored(term_vectors(documents, vocabulary), "vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    # At most one row per term of the block.
    holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    order = sorted(range(len(vocabulary)), key=lambda t: (-holding.get(t, 0), t))
    place = {t: i for i, t in enumerate(order)}
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(t, 0) + 1))) for t in order], np.int64)
    number = {term: place[t] for t, term in enumerate(vocabulary)}
    block = Block([(item, np.array(sorted(number[t] for t in terms), np.int64)) for item, terms in held.items() if terms], weights)
    places = np.array([place[t] for t in range(len(vocabulary))], np.int32)

    def ordered(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Entries in descending document frequency of their terms."""
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        terms, counts = places[lists.flatten().to_numpy()], batch.column(3).flatten().to_numpy()
        at = np.lexsort((terms, owner))
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.ListArray.from_arrays(offsets, pa.array(terms[at], pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(counts[at], pa.int64())),
            ],
            ["doc_id", "n", "terms", "counts"],
        )

    named = vectors.where("doc_id IS NOT NULL AND size(terms) > 0")
    search = _searched(block, n_docs, n_terms, k, shard_entries, leaf)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return search(ordered(b) for b in batches if b.num_rows)

    return named.mapInArrow(work, "item_id long, doc_id long, score long")


RANKED_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), stats AS (
    SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::HUGEINT AS n_terms FROM docs
), entries AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
    FROM entries, stats GROUP BY term, n_docs
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), scored AS (
    SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * n_docs) // n_terms)))) AS score
    FROM wanted JOIN weights USING (term) JOIN entries USING (term) JOIN docs USING (r), stats GROUP BY item_id, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score::BIGINT AS score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
