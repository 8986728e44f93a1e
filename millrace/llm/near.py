"""MinHash near-duplicates: an LSH forest proposes, full shingle sets decide.

Each distinct shingle set has a place in several trees, each an order of its MinHash values. Sets that share a tree's first
values, as many as the similarity allows, form a region; there are as many trees as it takes to meet each similar pair in
one of them but for one in :data:`MISSED`. A small region is compared as a whole. A large one is sorted by its tree's order, where
the longest common prefixes are those of neighbours, and cut into stretches of that order: it is as deep as it takes
to make a stretch small. What that leaves apart in a large region is compared in blocks, each set outside the region's
main component with all sets of other components, so that depth loses no link and a region of near-copies costs no more than
its sort. Tasks send spanning forests, never all pairs. Candidates' components are clusters, in which the full sets are
compared in the same way; what they confirm gives the final components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components, stored
from millrace.llm.text import by_batch, mix, shingles, steps, text_bytes

#: Chance that no tree brings a pair at the threshold together, and that its signatures disagree too much.
MISSED = 1e-6
#: Sets in a block of a region, and shingles in a block of a cluster.
REGION_BLOCK = 600
CLUSTER_BLOCK = 250_000

_EDGES = "a long, b long"


class Forest:
    """Depth, trees and signature bound for a similarity."""

    def __init__(self, similarity: float, missed: float = MISSED):
        # The deepest prefix that two similar sets still share in about half of the trees.
        self.depth = max(1, int(math.log(0.5) / math.log(similarity))) if similarity < 1 else 8
        met = similarity**self.depth
        self.trees = max(1, math.ceil(math.log(missed) / math.log(1 - met))) if met < 1 else 1
        self.hashes = self.depth * self.trees
        tail, agree = 0.0, 0
        while agree <= self.hashes:
            tail += math.comb(self.hashes, agree) * similarity**agree * (1 - similarity) ** (self.hashes - agree)
            if tail > missed:
                break
            agree += 1
        self.agree = agree
        self.multipliers = mix(np.arange(1, self.hashes + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)

    def signatures(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For rows with shingles: their numbers, the tree keys, and one byte of each MinHash value."""
        rows = np.flatnonzero(np.diff(first))
        starts = first[:-1][rows]
        least = np.empty((len(rows), self.hashes), np.uint64)
        if len(rows):
            for k, multiplier in enumerate(self.multipliers):
                least[:, k] = np.minimum.reduceat(hashes * multiplier, starts)
        least = mix(least)
        keys = np.empty((len(rows), self.trees), np.uint64)
        for tree in range(self.trees):
            part = least[:, tree * self.depth : (tree + 1) * self.depth]
            order = self.multipliers[: self.depth] * np.uint64(2 * tree + 1)
            keys[:, tree] = mix((part * order).sum(axis=1, dtype=np.uint64) + np.uint64(tree))
        return rows, keys.view(np.int64), (least >> np.uint64(56)).astype(np.uint8)


def set_digests(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each row's set, 0 for an empty one."""
    rows = np.flatnonzero(np.diff(first))
    sums = np.zeros((2, len(first) - 1), np.uint64)
    if len(rows):
        starts = first[:-1][rows]
        sums[0, rows] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), starts)
        sums[1, rows] = np.add.reduceat(mix(hashes + np.uint64(0x14057B7EF767814F)), starts)
    return sums


def with_digests(documents: DataFrame, size: int) -> DataFrame:
    """The documents, all columns, with ``__n, __d1, __d2``: the size and the digests of their shingle sets."""
    place = documents.columns.index("text")
    names = ("__n", "__d1", "__d2")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(place))
        found = [np.empty((3, 0), np.int64)]
        for low, high in steps(offsets):
            hashes, first = shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
            found.append(np.vstack([np.diff(first), set_digests(hashes, first).view(np.int64)]))
        added = [pa.array(column, pa.int64()) for column in np.hstack(found)]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    fields = [T.StructField(name, T.LongType()) for name in names]
    return by_batch(documents, work, T.StructType([*documents.schema.fields, *fields]))


def signature_table(documents: DataFrame, size: int, forest: Forest) -> DataFrame:
    """``doc_id, n, d1, d2, keys, signature``; equal sets have equal ``d1, d2`` (0 without shingles, and then no keys)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = text_bytes(batch.column(1))
        counts, one, two, keys, signatures = [], [], [], [], []
        for low, high in steps(offsets):
            hashes, first = shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
            rows, tree_keys, signature = forest.signatures(hashes, first)
            n = np.diff(first)
            sums = set_digests(hashes, first)
            counts.append(n)
            one.append(sums[0].view(np.int64))
            two.append(sums[1].view(np.int64))
            of_row = dict(zip(rows.tolist(), range(len(rows)), strict=True))
            keys.extend(tree_keys[of_row[r]] if r in of_row else np.empty(0, np.int64) for r in range(len(n)))
            signatures.extend(signature[of_row[r]].tobytes() if r in of_row else b"" for r in range(len(n)))
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(join(counts), pa.int64()),
                pa.array(join(one), pa.int64()),
                pa.array(join(two), pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
            ],
            ["doc_id", "n", "d1", "d2", "keys", "signature"],
        )

    schema = "doc_id long, n long, d1 long, d2 long, keys array<long>, signature binary"
    return by_batch(documents.select("doc_id", "text"), work, schema)


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (region, i, j), which stand together, as one batch."""
    key, waiting = None, []
    for batch in batches:
        region, i, j = (batch.column(c).to_numpy() for c in range(3))
        edges = np.flatnonzero((np.diff(region) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, len(region)], strict=True):
            if high == low:
                continue
            if key != (own := (region[low], i[low], j[low])) and waiting:
                yield _together(waiting)
                waiting = []
            key = own
            waiting.append(batch.slice(low, high - low))
    if waiting:
        yield _together(waiting)


def _stretches(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of each (region, turn) in stretches of about ``block``; each begins with the last row of the one before."""
    key, waiting, weight, fresh = None, [], 0, 0
    for batch in batches:
        low = 0
        columns = (batch.column(c).to_pylist() for c in ("region", "turn", "weight"))
        for at, (region, turn, size) in enumerate(zip(*columns, strict=True)):
            if key != (region, turn) or (fresh and weight + size > block):
                if at > low:
                    waiting.append(batch.slice(low, at - low))
                if waiting:
                    yield _together(waiting)
                last = waiting[-1].slice(waiting[-1].num_rows - 1) if waiting and key == (region, turn) else None
                waiting, weight = ([], 0) if last is None else ([last], last.column("weight")[0].as_py())
                key, low, fresh = (region, turn), at, 0
            weight, fresh = weight + size, fresh + 1
        if low < batch.num_rows:
            waiting.append(batch.slice(low))
    if waiting:
        yield _together(waiting)


def _linked(groups: Iterator[pa.RecordBatch], links: Callable[[pa.RecordBatch], list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for group in groups:
        if group.num_rows > 1:
            found.extend(links(group))
        if len(found) > 10_000:
            yield _edges(found)
            found = []
    if found:
        yield _edges(found)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def forest_links(
    ids: np.ndarray, neighbours: Callable[[int], np.ndarray], component: np.ndarray, asks: np.ndarray
) -> list[tuple[int, int]]:
    """A spanning forest over components of the graph in which row u, if it asks, has ``neighbours(u)``; ends once all is one."""
    names, labels = np.unique(component, return_inverse=True)
    out = []
    left = len(names)
    for u in np.flatnonzero(asks):
        if left == 1:
            break
        near = neighbours(u)
        roots, at = np.unique(labels[near], return_index=True)
        fresh = roots != labels[u]
        if fresh.any():
            out.extend((int(ids[u]), int(ids[v])) for v in near[at[fresh]])
            merged = np.append(roots[fresh], labels[u])
            labels[np.isin(labels, merged)] = merged.min()
            left -= int(fresh.sum())
    return out


def _flags(group: pa.RecordBatch) -> list[np.ndarray]:
    return [group.column(name).to_numpy(zero_copy_only=False) for name in ("node", "component", "asks")]


def similar_signatures(group: pa.RecordBatch, agree: int) -> list[tuple[int, int]]:
    ids, component, asks = _flags(group)
    lines = np.frombuffer(b"".join(group.column("payload").to_pylist()), np.uint8).reshape(len(ids), -1)
    return forest_links(ids, lambda u: np.flatnonzero((lines == lines[u]).sum(axis=1) >= agree), component, asks)


def similar_sets(group: pa.RecordBatch, size: int, part: int, whole: int) -> list[tuple[int, int]]:
    """Links of sets with ``whole * intersection >= part * union``."""
    ids, component, asks = _flags(group)
    data, offsets = text_bytes(group.column("payload"))
    parts = [
        (hashes, np.diff(first))
        for low, high in steps(offsets)
        for hashes, first in [shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)]
    ]
    hashes, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    names, local = np.unique(hashes, return_inverse=True)
    some = np.flatnonzero(sizes)
    ids, component, asks, sizes = ids[some], component[some], asks[some], sizes[some]
    first = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(names), np.int64)

    def neighbours(u: int) -> np.ndarray:
        own = local[first[u] : first[u + 1]]
        # Sets of too different a size can't be similar.
        fit = np.flatnonzero((whole * sizes >= part * sizes[u]) & (whole * sizes[u] >= part * sizes))
        marked[own] = 1
        if len(fit) == len(sizes):
            shared = np.add.reduceat(marked[local], first[:-1])
        else:
            shared = np.array([marked[local[first[v] : first[v + 1]]].sum() for v in fit])
        marked[own] = 0
        return fit[whole * shared >= part * (sizes[fit] + sizes[u] - shared)]

    return forest_links(ids, neighbours, component, asks)


def _region_components(
    small: DataFrame,
    large: DataFrame | None,
    block: int,
    orders: list[Column],
    links: Callable[[pa.RecordBatch], list[tuple[int, int]]],
    nodes: int,
) -> DataFrame:
    """``node, component`` of all that ``links`` finds similar in one region, directly or through others.

    Both tables have ``region, node, weight, payload``. The regions of ``small`` are compared whole, those of ``large``, which must
    be stored, in stretches of about ``block`` of each order, and then by what that left apart. ``nodes`` bounds the number of nodes.
    """
    alone = [F.col("node").alias("component"), F.lit(True).alias("asks")]
    one = F.lit(0)
    dealt = small.select("region", one.alias("i"), one.alias("j"), "node", "payload", *alone).repartition("region")
    found = dealt.sortWithinPartitions("region", "node").mapInArrow(lambda batches: _linked(_groups(batches), links), _EDGES)
    if large is None:
        return _with_roots(components(found))

    place = ["region", "turn", "label", "node"]
    for turn, order in enumerate(orders):
        line = large.select("region", F.lit(turn).alias("turn"), order.alias("label"), "node", "weight", "payload", *alone)
        line = line.repartitionByRange(*place).sortWithinPartitions(*place)
        found = found.unionByName(line.mapInArrow(lambda batches: _linked(_stretches(batches, block), links), _EDGES))
    known = stored(_with_roots(components(found)), "joined", nodes)

    # What isn't in the main component of its region asks all others there.
    own = known.select(F.col("node").alias("known"), "component")
    placed = large.select("region", "node", "weight").join(own, F.col("node") == F.col("known"), "left")
    placed = stored(placed.select("region", "node", "weight", F.coalesce("component", "node").alias("component")), "placed")
    parts = placed.groupBy("region", "component").agg(F.sum("weight").alias("part"))
    regions = parts.groupBy("region").agg(F.max(F.struct("part", "component")).alias("main"), F.sum("part").alias("total"))
    regions = regions.where("total > main.part").select(
        "region",
        F.col("main.component").alias("main"),
        F.ceil(F.col("total") / block).cast("int").alias("blocks"),
        F.ceil((F.col("total") - F.col("main.part")) / block).cast("int").alias("turns"),
    )
    regions = stored(regions, "regions", large.count())
    if regions.isEmpty():
        return known
    # Both sides of each join are stored, so that Spark can split a large region.
    asked = stored(placed.join(regions, "region").select("region", "node", "component", "main", "blocks", "turns"), "asked")
    asked = asked.join(large.select("region", "node", "payload"), ["region", "node"]).withColumn("asks", F.col("component") != F.col("main"))
    turn = F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")).cast("int")
    part = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    columns = ["region", "i", "j", "node", "payload", "component", "asks"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    answering = asked.withColumn("i", every("turns")).withColumn("j", part).withColumn("asks", F.lit(False))
    asking = asked.where("asks").withColumn("i", turn).withColumn("j", every("blocks"))
    dealt = answering.select(*columns).unionByName(asking.select(*columns)).repartition("region", "i", "j")
    dealt = dealt.sortWithinPartitions("region", "i", "j", "node")
    more = stored(dealt.mapInArrow(lambda batches: _linked(_groups(batches), links), _EDGES), "strays")
    if more.isEmpty():
        return known
    # Components of the known ones, which are few against their sets.
    for end in ("a", "b"):
        more = more.join(own, F.col(end) == F.col("known"), "left").withColumn(end, F.coalesce("component", end)).select("a", "b")
    wider = _with_roots(components(more))
    moved = known.join(wider.select(F.col("node").alias("root"), F.col("component").alias("now")), F.col("component") == F.col("root"), "left")
    return moved.select("node", F.coalesce("now", "component").alias("component")).unionByName(wider).distinct()


def _classes(documents: DataFrame, size: int, part: int, whole: int) -> tuple[DataFrame, DataFrame]:
    """The signature table, and ``d1, d2, least, component_id, keeper`` of each distinct set.

    ``least`` is the smallest id of the documents that have the set. Of the sets of a component one is its keeper: that
    of the smallest id, or of the smallest digests where no document of the component has an id.
    """
    forest = Forest(part / whole)
    table = stored(signature_table(documents, size, forest), "signatures")
    # Exact copies, however many, are one set from here on; they are combined before the shuffle. A set is known by a
    # number of its own, given once, when the sets are stored: ids may be null, or used for several texts.
    sets = (
        table.where(F.col("n") > 0)
        .groupBy("d1", "d2")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
    )
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets", table.count())
    nodes = sets.count()

    keyed = sets.select("node", F.posexplode("keys").alias("tree", "region"))
    # Stored, so that both sides of the next join are plain shuffles and Spark can split a large region.
    shared = stored(keyed.groupBy("region").agg(F.count("*").alias("members")).where(F.col("members") > 1), "regions", nodes * forest.trees // 2)

    def placed(regions: DataFrame) -> DataFrame:
        rows = keyed.join(regions, "region").join(sets.select("node", "signature"), "node")
        return rows.select("region", "tree", "node", F.lit(1).cast("long").alias("weight"), F.col("signature").alias("payload"))

    crowded = shared.where(F.col("members") > REGION_BLOCK)
    large = None if crowded.isEmpty() else stored(placed(crowded), "large", nodes * forest.trees)
    # A tree's order begins with its own values and goes on with those of the trees after it.
    before = F.col("tree") * forest.depth
    order = F.concat(F.col("payload").substr(before + 1, F.lit(forest.hashes)), F.col("payload").substr(F.lit(1), before))
    agree = forest.agree
    clusters = _region_components(
        placed(shared.where(F.col("members") <= REGION_BLOCK)),
        large,
        REGION_BLOCK,
        [order],
        lambda group: similar_signatures(group, agree),
        nodes,
    )
    clusters = stored(clusters, "clusters", nodes)

    members = clusters.join(sets.select("node", "n", "d1", "d2", "least", "signature"), "node")
    weights = members.groupBy("component").agg((F.sum("n") > CLUSTER_BLOCK).alias("heavy"))
    weights = stored(weights, "weights", nodes)
    members = members.join(weights, "component").withColumnRenamed("component", "region")
    # One text of each member; copies have other ids, and repeated rows are combined before the next shuffle.
    texts = with_digests(documents.select("doc_id", "text"), size)
    own = [F.col("__d1") == F.col("d1"), F.col("__d2") == F.col("d2"), F.col("doc_id").eqNullSafe(F.col("least"))]
    texts = texts.join(members, own).groupBy("node", "region", "heavy").agg(
        F.first("n").alias("weight"), F.first("signature").alias("signature"), F.first("text").alias("payload")
    )
    large = None
    if not weights.where("heavy").isEmpty():
        texts = stored(texts, "texts")
        texts, large = texts.where(~F.col("heavy")), texts.where("heavy")
    half = F.lit(forest.hashes // 2)
    turned = F.concat(F.col("signature").substr(half + 1, F.lit(forest.hashes)), F.col("signature").substr(F.lit(1), half))
    confirmed = _region_components(
        texts, large, CLUSTER_BLOCK, [F.col("signature"), turned], lambda group: similar_sets(group, size, part, whole), nodes
    )

    known = sets.select("node", "d1", "d2", "least")
    linked = stored(confirmed, "confirmed", nodes).join(known, "node")
    best = F.min(F.struct(F.col("least").isNull().alias("nameless"), "least", "d1", "d2")).alias("best")
    linked = linked.join(linked.groupBy("component").agg(best), "component")
    linked = linked.select(F.col("node").alias("linked"), "best")
    found = known.join(linked, F.col("node") == F.col("linked"), "left")
    alone = F.col("linked").isNull()
    return table, found.select(
        "d1",
        "d2",
        "least",
        F.when(alone, F.col("least")).otherwise(F.col("best.least")).alias("component_id"),
        (alone | (F.col("best.d1") == F.col("d1")) & (F.col("best.d2") == F.col("d2"))).alias("keeper"),
    )


def _with_roots(found: DataFrame) -> DataFrame:
    """Components with their own nodes, which :func:`components` doesn't list."""
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def near_duplicates(documents: DataFrame, size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Two documents are linked if ``whole * intersection >= part * union`` of their sets of ``size``-word shingles;
    ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` whether it is the document's own.
    Texts without words, empty and null ones have no shingles and are linked with nothing. Repeated rows are
    exact copies with one id; different texts that share an id are different documents. Rows with a null id take the
    component of the documents they are linked with, or null, and are kept only in the latter case.
    """
    table, sets = _classes(documents, size, part, whole)
    answers = sets.select("d1", "d2", "component_id")
    found = table.where(F.col("n") > 0).join(answers, ["d1", "d2"]).select("doc_id", "n", "component_id")
    alone = table.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def without_near_duplicates(documents: DataFrame, size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The documents, all columns, one row of each component: one of the smallest id that has one.

    Different texts that share an id stay if they aren't linked. Of documents with a null id one stays if none of
    its component has an id. Documents without shingles are linked with nothing: all of them stay.
    """
    _, sets = _classes(documents, size, part, whole)
    keepers = sets.where("keeper").select(F.col("d1").alias("__k1"), F.col("d2").alias("__k2"), F.col("least").alias("__least"))
    marked = with_digests(documents, size)
    own = [F.col("__d1") == F.col("__k1"), F.col("__d2") == F.col("__k2"), F.col("doc_id").eqNullSafe(F.col("__least"))]
    kept = marked.where("__n > 0").join(keepers, own).dropDuplicates(["__d1", "__d2"])
    return kept.select(*marked.columns).unionByName(marked.where("__n = 0")).drop("__n", "__d1", "__d2")
