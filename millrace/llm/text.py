"""Arrow text columns as byte arrays, vectorised word hashes, and the split of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
STEP_ROWS = 1024

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes with A-Z lower-cased.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE_CODES = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES, rows: int = STEP_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes and at most ``rows`` rows; every row is in exactly one."""
    low = 0
    while low < len(offsets) - 1:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), low + rows, len(offsets) - 1)
        yield low, high
        low = high


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def prefix_hashes(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers from which :func:`span_hash` hashes any span."""
    powers = np.full(len(data) + 1, _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers[:-1], out=sums[1:])
    inverse = np.full(len(data) + 1, _BASE_INVERSE, np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    return sums, inverse


def span_hash(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever the span stands."""
    return mix((sums[end] - sums[start]) * inverse[start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, in order.

    Words are runs without the six ASCII white-space characters, after lower-casing A-Z.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = LOWERED[data]
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    first[starts] = inside[starts]  # a row's end also ends its last word
    start = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:] - 1
    ends = ends[ends >= 0]
    last[ends] |= inside[ends]
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return span_hash(*prefix_hashes(data), start, end), row


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct word shingles of each row, and where each row's begin.

    A row of fewer words, but not none, has its whole sequence as the only shingle.
    """
    word, row = words(data, offsets)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])
    weights = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    whole = len(word) - size + 1
    hashes, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    if whole > 0:
        inside = row[:whole] == row[size - 1 :]
        summed = np.zeros(whole, np.uint64)
        for k in range(size):
            summed += word[k : k + whole] * weights[k]
        hashes, owner = mix(summed[inside]), row[:whole][inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = np.array(
            [(word[first[r] : first[r + 1]] * weights[: count[r]]).sum(dtype=np.uint64) + np.uint64(count[r]) for r in short],
            np.uint64,
        )
        hashes, owner = np.concatenate([hashes, mix(extra)]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[keep], owner[keep]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def by_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """Applies ``work`` to each Arrow batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)

    return df.mapInArrow(each, schema)


def held_out(doc_id: Column) -> Column:
    """The rows that labels are never learned from: crc32 of the id as text, mod 5, is 0. False for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``text`` and ``label`` of at most ``rows`` labelled documents outside the held-out part.

    The sample is the first in the order of a hash of ``doc_id``, so reruns agree. Rows with a null id,
    text or label are left out; an id labelled more than once counts as 1 if any label is 1.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = documents.select(F.col("doc_id").alias("_id"), "text").where(F.col("text").isNotNull())
    # At most ``rows`` ids and labels: a bounded broadcast.
    found = texts.join(F.broadcast(chosen), "_id")
    return found.orderBy(F.xxhash64("_id"), "_id", F.xxhash64("text")).limit(rows).select("text", "label")
