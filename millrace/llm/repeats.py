"""Repeated byte strings: a logarithmic family of sparse suffix arrays.

A window is a string of ``length`` bytes. Each window chooses one anchor: the position with the smallest
fingerprint among its first ``WINDOW`` positions, where a fingerprint covers the following
``length - WINDOW + 1`` bytes (its core), so the core lies inside the window. Equal windows choose equal cores.
The suffixes that start at anchors are the ones indexed: a batch of documents gets an array of their cores,
sorted by fingerprint; a new array is merge-scanned against the levels there are, and levels of one rank merge into
the next, so that each suffix is rewritten a logarithmic number of times. Cores met once end here.

Windows that follow one another with one anchor form a run. Runs over equal bytes are repeated as a whole. What is
left are the runs at the edges of long matches: their bytes meet by core, together with one witness of each kind of
equal runs there, and their windows are compared. A core with very many open runs and witnesses is dealt to several
tasks, whose distinct windows are then counted together. No step holds all runs of a core in one task.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import mix, prefix_hashes, span_hash, steps, text_bytes
from millrace.session import scratch_path

LENGTH = 400
WINDOW = 180
#: Batches that the documents are indexed in.
BATCHES = 5
#: Open runs and witnesses of a core in one task, on average.
GROUP_RUNS = 4_000

#: Bytes in one vectorised step over a long text; positions take 24 bits of a packed word.
_PIECE = 1 << 22
_LOW = np.uint64((1 << 24) - 1)
_CODES = np.random.default_rng(77001).integers(1, 2**63, 256, dtype=np.uint64)

ENTRY = "doc_id long, mark long, key long, digest long, start long, n int, back int"


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, window: int = WINDOW):
    """Runs of windows with one anchor: row, start in the row, windows, anchor after start, core, digest of its bytes."""
    core = length - window + 1
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty, empty
    sums, inverse = prefix_hashes(data)
    at = np.arange(len(data) - core + 1)
    fingerprint = span_hash(sums, inverse, at, at + core)
    m = len(fingerprint)
    blocks = -(-m // window)
    packed = np.full(blocks * window, np.uint64(2**64 - 1))
    packed[:m] = (fingerprint & ~_LOW) | at.astype(np.uint64)
    grid = packed.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - window + 1], ahead[window - 1 : m])
    first = np.arange(len(least))
    row = np.searchsorted(offsets, first, side="right") - 1
    start = first[first + length <= offsets[row + 1]]
    if not len(start):
        return empty, empty, empty, empty, empty, empty
    row = row[start]
    anchor = (least[start] & _LOW).astype(np.int64)
    edge = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(start) != 1) | (np.diff(row) != 0)) + 1
    low = np.concatenate([[0], edge])
    high = np.concatenate([edge, [len(start)]]) - 1
    n = start[high] - start[low] + 1
    other, other_inverse = prefix_hashes(data, _CODES)
    digest = span_hash(other, other_inverse, start[low], start[high] + length) ^ mix(n.astype(np.uint64))
    return row[low], start[low] - offsets[row[low]], n, anchor[low] - start[low], fingerprint[anchor[low]], digest


def pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first row, place in that row) of steps; very long texts overlap by ``length - 1`` bytes."""
    for low, high in steps(offsets):
        size = int(offsets[high] - offsets[low])
        if high - low == 1 and size > _PIECE:
            for at in range(0, size, _PIECE - length + 1):
                part = data[offsets[low] + at : min(offsets[low] + at + _PIECE, offsets[high])]
                yield part, np.array([0, len(part)]), low, at
        else:
            yield data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], low, 0


def suffix_entries(documents: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """A row per run of every document; ``mark`` tells texts with one id apart."""

    def work(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0)
            for part, places, first, shift in pieces(data, offsets, length):
                row, start, n, back, key, digest = runs(part, places, length, window)
                if not len(row):
                    continue
                own = first + row
                names, local = np.unique(own, return_inverse=True)
                marks = np.array([zlib.crc32(data[offsets[r] : offsets[r + 1]]) for r in names], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(own)),
                        pa.array(marks[local]),
                        pa.array(key.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        pa.array(start + shift),
                        pa.array(n.astype(np.int32)),
                        pa.array(back.astype(np.int32)),
                    ],
                    [c.split()[0] for c in ENTRY.split(", ")],
                )

    return documents.select("doc_id", "text").mapInArrow(work, ENTRY)


class SuffixLevels:
    """The family: each level is a stored array of cores with their numbers of suffixes, sorted by core.

    An array is a table cut into buckets by a hash of the core. Scans and merges join two of them bucket by bucket, as
    sorted runs, without a shuffle. A table is dropped from the catalog when it is merged or the family closed; its files lie in the
    shared scratch folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []
        self.found: list[str] = []
        # As many as the grouping has partitions, so that a bucket is one file.
        self.buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)

    def _store(self, array: DataFrame, rank: int) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, f"suffixes-{rank}")
        array.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")

    def add(self, entries: DataFrame) -> None:
        """The batch's array, merge-scanned against each level, then merged with the level of its rank, the next, and so on."""
        table = self.spark.table
        rank, name = 0, self._store(entries.groupBy("key").agg(F.count("*").alias("n")), 0)
        array = table(name)
        found = array.where("n > 1").select("key")
        for _, level in self.levels:
            found = found.unionByName(array.join(table(level).hint("merge"), "key", "left_semi").select("key"))
        path = scratch_path(self.spark, "matches")
        found.write.parquet(path)
        self.found.append(path)
        while self.levels and self.levels[-1][0] == rank:
            old = self.levels.pop()[1]
            one, two = table(old).withColumnRenamed("n", "n1"), table(name).withColumnRenamed("n", "n2")
            both = one.join(two.hint("merge"), "key", "full_outer")
            n = F.coalesce("n1", F.lit(0)) + F.coalesce("n2", F.lit(0))
            rank += 1
            merged = self._store(both.select("key", n.alias("n")), rank)
            self._drop(old)
            self._drop(name)
            name = merged
        self.levels.append((rank, name))

    def repeated(self) -> DataFrame:
        """The cores of at least two suffixes, once for each scan that found them.

        Plain stored rows: a join with them is one that Spark can split where a core is very frequent.
        """
        return self.spark.read.schema("key long").parquet(*self.found)

    def close(self) -> None:
        """Drops the levels; what the scans found stays readable."""
        while self.levels:
            self._drop(self.levels.pop()[1])


def _compare(group: pa.Table, length: int, several: bool):
    """Windows of a group of open runs: spans repeated inside the group, and, if it is one of several, all distinct windows."""
    texts = group.column("bytes").to_pylist()
    n = group.column("n").to_numpy()
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    run = np.repeat(np.arange(len(n)), n)
    at = begin[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    one = span_hash(*prefix_hashes(data), at, at + length)
    two = span_hash(*prefix_hashes(data, _CODES), at, at + length)
    order = np.lexsort((two, one))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    label = np.cumsum(fresh) - 1
    count = np.bincount(label)
    repeated = np.empty(len(order), bool)
    repeated[order] = count[label] > 1
    own = group.column("own").to_numpy(zero_copy_only=False)[run]
    hit = repeated & own
    # Neighbouring windows of a run become one span.
    step = np.flatnonzero(hit)
    cut = np.flatnonzero((np.diff(step) != 1) | (np.diff(run[step]) != 0)) + 1
    low, high = np.concatenate([[0], cut]), np.concatenate([cut, [len(step)]])
    first = step[low[high > low]]
    spans = (run[first], at[first] - begin[run[first]], (high - low)[high > low])
    windows = None
    if several:
        lead = order[fresh]
        windows = (run[lead], at[lead] - begin[run[lead]], one[lead], two[lead], count, own[lead])
    return spans, windows


_FOUND = "doc_id long, mark long, start long, n int, h1 long, h2 long, count long"


def _open_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def rows(group: pa.Table):
        several = group.column("salts")[0].as_py() > 1
        (run, at, n), windows = _compare(group, length, several)
        take = lambda name, index: group.column(name).take(pa.array(index)).combine_chunks()
        start = group.column("start").to_numpy()
        none = pa.nulls(len(run), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [take("doc_id", run), take("mark", run), pa.array(start[run] + at), pa.array(n.astype(np.int32)), none, none, none], names
        )
        if windows is not None:
            run, at, one, two, count, own = windows
            # The place counts only where the window is met once here and asked for.
            alone = pa.array((count == 1) & own)
            n = pa.array(np.ones(len(run), np.int32), mask=~np.asarray(alone))
            yield pa.RecordBatch.from_arrays(
                [take("doc_id", run), take("mark", run), pa.array(start[run] + at), n, pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(count)],
                names,
            )

    key, waiting = None, []
    for batch in batches:
        core, salt = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((np.diff(core) != 0) | (np.diff(salt) != 0)) + 1
        for low, high in zip([0, *edges], [*edges, len(core)], strict=True):
            if high == low:
                continue
            if key != (own := (core[low], salt[low])) and waiting:
                yield from rows(pa.Table.from_batches(waiting))
                waiting = []
            key = own
            waiting.append(batch.slice(low, high - low))
    if waiting:
        yield from rows(pa.Table.from_batches(waiting))


@contextlib.contextmanager
def filtered_joins(spark: SparkSession):
    """Lets Spark filter the large side of a join by a bounded Bloom filter of the small side before the shuffle."""
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(1 << 40),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def repeated_spans(documents: DataFrame, length: int = LENGTH, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """``doc_id, mark, start, n``: the ``n`` windows from byte ``start`` on also start elsewhere."""
    spark = documents.sparkSession

    def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.partitionBy(*by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    entries = suffix_entries(documents, length, window)
    entries = stored(entries.withColumn("batch", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(batches)).cast("int")), "runs", "batch")
    family = SuffixLevels(spark)
    try:
        for batch in range(batches):
            family.add(entries.where(F.col("batch") == batch))
    finally:
        family.close()
    candidates = stored(entries.drop("batch").join(family.repeated(), "key", "left_semi"), "candidates")

    # Runs over equal bytes; one of each stays to witness for the open ones.
    same = ["key", "digest", "n"]
    # Stored, so that both sides of the next join are plain shuffles and Spark can split a frequent run.
    kinds = candidates.groupBy(*same).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "mark", "start")).alias("witness"))
    kinds = stored(kinds, "kinds")
    known = stored(candidates.join(kinds, same), "known")
    whole = known.where("copies > 1").select("doc_id", "mark", "start", "n")

    # Each kind sends one row: its open run or its witness.
    lone = kinds.groupBy("key").agg(F.count("*").alias("dealt"), F.min("copies").alias("fewest"))
    lone = stored(lone.where("fewest = 1").select("key", "dealt"), "lone")
    witness = F.struct("doc_id", "mark", "start").eqNullSafe(F.col("witness"))
    asked = known.where((F.col("copies") == 1) | witness).join(lone, "key")
    asked = asked.dropDuplicates([*same, "doc_id", "mark", "start"])
    run = F.struct("key", "dealt", "start", "n", (F.col("copies") == 1).alias("own"))
    asked = stored(asked.groupBy("doc_id", "mark").agg(F.collect_list(run).alias("runs")), "asked")
    joined = documents.select(F.col("doc_id").alias("text_id"), "text").join(
        asked.where("mark >= 0"), F.col("text_id").eqNullSafe(F.col("doc_id")) & (F.crc32(F.col("text").cast("binary")) == F.col("mark"))
    )

    def cut(batches):
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in range(4)]
            for doc_id, mark, text, own in zip(*columns, strict=True):
                data = text.encode()
                for r in own:
                    salts = -(-r["dealt"] // GROUP_RUNS)
                    salt = zlib.crc32(f"{doc_id} {mark} {r['start']}".encode()) % salts
                    out.append((r["key"], salt, salts, doc_id, mark, r["start"], r["n"], r["own"], data[r["start"] : r["start"] + r["n"] + length - 1]))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            yield _rows(out)

    fields = [("key", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("own", pa.bool_()), ("bytes", pa.binary())]

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, (_, t) in enumerate(fields)], [name for name, _ in fields])

    schema = "key long, salt int, salts int, doc_id long, mark long, start long, n int, own boolean, bytes binary"
    dealt = joined.select("doc_id", "mark", "text", "runs").mapInArrow(cut, schema)
    # A text that repeats under one id and one mark is one text here.
    dealt = dealt.repartition("key", "salt").sortWithinPartitions("key", "salt", "doc_id", "mark", "start")
    with filtered_joins(spark):
        found = stored(dealt.mapInArrow(lambda batches: _open_windows(batches, length), _FOUND), "open")
    inside = found.where("h1 IS NULL").select("doc_id", "mark", "start", "n")
    spread = found.where("h1 IS NOT NULL")
    again = spread.groupBy("h1", "h2").agg(F.sum("count").alias("total")).where("total > 1").select("h1", "h2")
    across = spread.where("n IS NOT NULL").join(again, ["h1", "h2"], "left_semi").select("doc_id", "mark", "start", "n")
    return whole.unionByName(inside).unionByName(across)


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document what stays when every byte of a repeated string of ``length`` bytes is removed.

    ``doc_id, n_bytes, n_removed, n_spans, spans`` (array of ``{start, end}``, end exclusive) and ``kept``
    (binary). Null texts count as empty; texts shorter than ``length`` lose nothing; repeated rows are
    copies of each other; strings that overlap themselves count. Matches never cross documents.
    """
    mark = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    spans = repeated_spans(documents, length).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    spans = spans.withColumnsRenamed({"doc_id": "span_id", "mark": "span_mark"})
    texts = documents.select("doc_id", "text", mark.alias("mark"))
    joined = texts.join(spans, F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("mark") == F.col("span_mark")), "left")

    def work(batches):
        for batch in batches:
            sizes, removed, counts, lists, kept = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode()
                edges = merged([(f["start"], f["start"] + f["n"] + length - 1) for f in found or ()])
                at, rest = 0, []
                for low, high in edges:
                    rest.append(data[at:low])
                    at = high
                rest.append(data[at:])
                sizes.append(len(data))
                removed.append(sum(high - low for low, high in edges))
                counts.append(len(edges))
                lists.append([{"start": low, "end": high} for low, high in edges])
                kept.append(b"".join(rest))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, counts)), pa.array(lists, span), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary"
    return joined.select("doc_id", "text", "found").mapInArrow(work, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans' union as maximal spans, by start."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def repeat_report(documents: DataFrame) -> DataFrame:
    """:func:`without_repeats` with a digest of the bytes that stay."""
    return without_repeats(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The same by a table of all strings, for small inputs."""
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for i in range(len(d) - length + 1):
            key = hashlib.blake2b(d[i : i + length], digest_size=16).digest()
            seen[key] = seen.get(key, 0) + 1
    out = []
    for d in data:
        hit = [i for i in range(len(d) - length + 1) if seen[hashlib.blake2b(d[i : i + length], digest_size=16).digest()] > 1]
        edges = merged([(i, i + length) for i in hit])
        keep = bytearray(d)
        for low, high in reversed(edges):
            del keep[low:high]
        out.append((len(d), sum(h - w for w, h in edges), len(edges), hashlib.sha256(keep).hexdigest()))
    return out
