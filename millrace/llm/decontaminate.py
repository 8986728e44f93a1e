"""Benchmark decontamination: an Aho-Corasick automaton over the normalised benchmark.

Words are runs of letters, digits and non-ASCII characters, with A-Z lower-cased. Each benchmark text gives
its windows of ten consecutive words (a shorter one is a single window). A text is normalised byte for byte,
scanned once, and each occurrence is mapped back to the words and bytes of the original text.

The benchmark's texts are broadcast, measured while they are gathered, and each Python worker builds the
automaton once. An automaton holds at most ``BLOCK_BYTES`` of pattern text; a larger benchmark is several
automata, of which a worker holds one at a time and takes it over ``PASS_BYTES`` of documents before the next.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10

#: Pattern text of one automaton; about 40 times as much memory.
BLOCK_BYTES = 2_000_000

#: Text of documents that one of several automata is taken over before the next one is built.
PASS_BYTES = 32_000_000

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normalised(text: bytes) -> bytes:
    """The text with A-Z lower-cased and other ASCII but letters and digits as spaces; offsets stay."""
    return text.translate(_TABLE)


def windows(text: str, size: int = WINDOW) -> list[str]:
    """Windows of ``size`` words, each with a space before and after; bytes stand as Latin-1 characters."""
    found = normalised(text.encode()).split()
    spans = range(max(1, len(found) - size + 1)) if found else ()
    return [f" {b' '.join(found[i : i + size]).decode('latin-1')} " for i in spans]


def automaton(items: list[tuple[int, str]], size: int) -> ahocorasick.Automaton:
    """Maps every window to its number of words and the items that hold it."""
    held: dict[str, set[int]] = {}
    for item, text in items:
        for window in windows(text, size):
            held.setdefault(window, set()).add(item)
    built = ahocorasick.Automaton()
    for window, ids in held.items():
        built.add_word(window, (window.count(" ") - 1, ids))
    built.make_automaton()
    return built


def occurrences(text: bytes, built: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int, set[int]]]]:
    """Number of words, and (first word, words, items) of each occurrence."""
    found = normalised(text).split()
    joined = f" {b' '.join(found).decode('latin-1')} "
    hits = [(end, *value) for end, value in built.iter(joined)]
    if not hits:
        return len(found), []
    # The space at ``end`` closes the word before it: the number of spaces up to it is that word's number.
    spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(spaces, [end for end, _, _ in hits])
    return len(found), [(int(k) - n, n, ids) for k, (_, n, ids) in zip(last, hits, strict=True)]


def word_spans(text: bytes) -> np.ndarray:
    """Byte offsets (start, end) of the words in the original text."""
    inside = np.frombuffer(b" " + normalised(text) + b" ", np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges.reshape(-1, 2)


#: The automaton that this Python worker built last, and which one it is.
_last: tuple[tuple[str, int] | None, ahocorasick.Automaton | None] = (None, None)


class Scanner:
    """Scans batches of texts with the automata of all blocks."""

    def __init__(self, blocks: list[Broadcast], size: int):
        self.blocks, self.size, self.name = blocks, size, uuid.uuid4().hex

    def automaton(self, block: int) -> ahocorasick.Automaton:
        global _last
        if _last[0] != (self.name, block):
            _last = (None, None)  # frees the one before
            _last = ((self.name, block), automaton(self.blocks[block].value, self.size))
        return _last[1]

    def passes(self, batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[pa.RecordBatch]]:
        """The batches in groups: one each for a single automaton, else of about ``PASS_BYTES``."""
        group, held = [], 0
        for batch in batches:
            group.append(batch)
            held += batch.column(column).nbytes
            if len(self.blocks) == 1 or held >= PASS_BYTES:
                yield group
                group, held = [], 0
        if group:
            yield group

    def scan(self, batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, np.ndarray | None, set[int]]]]]:
        """Each batch with, per text: number of words, which of them are hit (None: none), and the items found."""
        for group in self.passes(batches, column):
            encoded = [[(t or "").encode() for t in batch.column(column).to_pylist()] for batch in group]
            state = [[[0, None, set()] for _ in texts] for texts in encoded]
            for block in range(len(self.blocks)):
                built = self.automaton(block)
                for texts, kept in zip(encoded, state, strict=True):
                    for text, found in zip(texts, kept, strict=True):
                        self.add(found, text, built)
            yield from zip(group, state, strict=True)

    @staticmethod
    def add(found: list, text: bytes, built: ahocorasick.Automaton) -> None:
        found[0], hits = occurrences(text, built) if len(built) else (len(normalised(text).split()), [])
        if not hits:
            return
        marks = np.zeros(found[0] + 1, np.int64)
        for first, n, ids in hits:
            marks[first] += 1
            marks[first + n] -= 1
            found[2] |= ids
        hit = np.cumsum(marks[:-1]) > 0
        found[1] = hit if found[1] is None else found[1] | hit


def scanner(benchmark: DataFrame, size: int) -> Scanner:
    context = benchmark.sparkSession.sparkContext
    return Scanner([context.broadcast(block) for block in benchmark_blocks(benchmark, size=size)], size)


def benchmark_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES, size: int = WINDOW) -> list[list[tuple[int, str]]]:
    """The benchmark's items in blocks of bounded pattern text. Items without id or words are left out.

    The benchmark is the stated query set; its rows stream through the driver and are kept once. There is always
    at least one block.
    """
    blocks: list[list[tuple[int, str]]] = [[]]
    room = most
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    for item, text in rows.toLocalIterator():
        need = (size + 1) * len(text.encode())
        if need > room and blocks[-1]:
            blocks.append([])
            room = most
        blocks[-1].append((item, text))
        room -= need
    return blocks


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: words, words inside benchmark windows, the items found, and the hit spans.

    Columns ``doc_id, n_words, n_hit, item_ids`` (array of strings, sorted) and ``spans`` (array of
    ``{start, end}``: byte offsets, end exclusive, of each run of hit words in the original text).
    Null and empty texts have no words and are never hit; repeated rows are scanned each; an empty
    benchmark hits nothing. Item ids that repeat count once.
    """
    scan = scanner(benchmark, size).scan

    def work(batches):
        for batch, found in scan(batches, 1):
            rows = []
            for text, (n, hit, ids) in zip(batch.column(1), found, strict=True):
                spans = []
                if hit is not None:
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2)
                    at = word_spans(text.as_py().encode())
                    spans = [{"start": int(at[a, 0]), "end": int(at[b - 1, 1])} for a, b in edges]
                rows.append((n, 0 if hit is None else int(hit.sum()), sorted(map(str, ids)), spans))
            n, hits, ids, spans = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array(ids, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                ["doc_id", "n_words", "n_hit", "item_ids", "spans"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_words long, n_hit long, item_ids array<string>, spans array<struct<start: long, end: long>>"
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents, all columns, in which no benchmark window occurs."""
    scan = scanner(benchmark, size).scan
    place = documents.columns.index("text")

    def work(batches):
        for batch, found in scan(batches, place):
            yield batch.filter(pa.array([not ids for _, _, ids in found], pa.bool_()))

    return documents.mapInArrow(work, documents.schema)


def digest(item_ids: list[str]) -> str:
    """Lower-case hex SHA-256 of the comma-joined ids, as the query reports it."""
    return hashlib.sha256(",".join(item_ids).encode()).hexdigest()


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """:func:`contamination` with the items as a count and a digest."""
    found = contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
