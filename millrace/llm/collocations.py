"""Phrase collocations: Misra-Gries summaries per hash partition name the frequent phrases, a second pass counts them.

Each task hashes the phrases of one to five words of its texts and counts equal hashes; the counts travel, packed, to the
hash partition that the first bits name. A partition's mass M is known before its counts come, and its summary has
more than M / threshold counters, so what all decrements together can take from one counter is below the threshold:
each frequent phrase survives. Survivors set a bit of a map of fixed size. The second pass counts, as text, each
phrase whose bit is set, again in blocks by hash partition; phrases that only share a bit with a frequent one cost an
entry there and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import LOWERED, mix, prefix_hashes, span_hash, steps, text_bytes
from millrace.operators.bounds import broadcast_if_small
from millrace.session import scratch_path

THRESHOLD = 100
LONGEST = 5
#: Phrases that a task counts together before it sends them.
FLUSH = 4_000_000
#: Text of one vectorised step.
STEP = 4 << 20
#: The map of survivors has 2 ** BITS bits: 16 MB, whatever the input.
BITS = 27
#: Bytes of text per hash partition, and the least partitions as a power of two.
PARTITION_BYTES = 16 << 20
LEAST = 6
#: Where counters of 32 bits stop; what has so many occurrences is frequent.
MOST = np.uint64((1 << 32) - 1)
#: Phrases that a hash partition adds up together.
MERGED = 1 << 20

_PACKED = ["part", "kind", "mass", "n_ones", "ones", "n_more", "more", "counts"]
_COUNTED = ["lang", "size", "phrase", "a"]

#: Tab and space between words; line ends and . , ; : ! ? between pieces.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 32]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
_PLACES = mix(np.arange(1, LONGEST + 1, dtype=np.uint64)) | np.uint64(1)


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _language_code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Words:
    """The words of some texts: hash, row, byte span, and the run of words without a break that each is in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data = LOWERED[data]
        split = _BREAK[data]
        inside = ~(split | _SPACE[data])
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]
        self.start = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = offsets[1:] - 1
        ends = ends[ends >= 0]
        last[ends] |= inside[ends]
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        breaks = np.cumsum(split)[self.start]
        new = np.ones(len(self.start), bool)
        new[1:] = (breaks[1:] != breaks[:-1]) | (self.row[1:] != self.row[:-1])
        self.run = np.cumsum(new)
        self.hash = span_hash(*prefix_hashes(data), self.start, self.end) if len(self.start) else np.empty(0, np.uint64)

    def phrases(self, n: int, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hashes of the phrases of ``n`` words that start at words ``at``, by the codes of their rows."""
        summed = codes[self.row[at]] + np.uint64(n)
        for k in range(n):
            summed = summed + self.hash[at + k] * _PLACES[k]
        return mix(summed)

    def whole(self, n: int) -> np.ndarray:
        """Where phrases of ``n`` words within one run start."""
        count = len(self.start) - n + 1
        return np.flatnonzero(self.run[:count] == self.run[n - 1 :]) if count > 0 else np.empty(0, np.int64)

    def texts(self, n: int, at: np.ndarray) -> pa.Array:
        """The phrases of ``n`` words from words ``at``, with single spaces."""
        plain = np.ones(len(at), bool)
        for k in range(n - 1):
            end = self.end[at + k]
            plain &= (self.start[at + k + 1] - end == 1) & (self.data[end] == 32)
        start, end = self.start[at[plain]], self.end[at[plain] + n - 1]
        if len(start):
            offsets = np.concatenate([[0], np.cumsum(end - start)])
            data = self.data[np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])]
            found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        else:
            found = pa.array([], pa.large_string())
        if plain.all():
            return found
        spans = (self.data[self.start[i] : self.end[i + n - 1]].tobytes() for i in at[~plain].tolist())
        others = pa.array([b" ".join(span.split()).decode() for span in spans], pa.large_string())
        order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        return pa.concat_arrays([found, others]).take(pa.array(order))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, pa.Array, np.ndarray]]:
    """Words, codes by row, languages, and languages by row, of one step of texts after the other."""
    for batch in batches:
        langs = pc.fill_null(batch.column(1).cast(pa.string()), "und").dictionary_encode()
        codes = np.array([_language_code(x) for x in langs.dictionary.to_pylist()], np.uint64)
        own = langs.indices.to_numpy(zero_copy_only=False)
        data, offsets = text_bytes(batch.column(0))
        for low, high in steps(offsets, STEP, 1 << 20):
            part = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            yield part, codes[own[low:high]], langs.dictionary, own[low:high]


def _set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set in a map whose size is a power of two."""
    place = hashes >> np.uint64(62 - len(bits).bit_length())
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _parts(hashes: np.ndarray, power: int) -> Iterator[tuple[int, int, int]]:
    """Partition, begin and end of each range of sorted hashes that agree in the first ``power`` bits."""
    parts, begin = np.unique(hashes >> np.uint64(64 - power), return_index=True)
    yield from zip(parts.tolist(), begin.tolist(), [*begin[1:].tolist(), len(hashes)])


def _squeezed(values: np.ndarray) -> bytes:
    """Sorted 32-bit values: their differences, byte by byte of one rank, compressed."""
    planes = np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unsqueezed(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, "zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _packed(hashes: np.ndarray, power: int) -> pa.RecordBatch:
    """Counts of equal hashes, one row for the mass and one for the counters of each hash partition.

    A counter keeps the 32 bits after those that name its partition. Counters of one are listed by themselves.
    """
    values, counts = np.unique(hashes >> np.uint64(32 - power), return_counts=True)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    rows = []
    for p, a, b in _parts(values << np.uint64(32 - power), power):
        single = counts[a:b] == 1
        ones, more = low[a:b][single], low[a:b][~single]
        rows.append((p, 0, int(counts[a:b].sum()), 0, None, 0, None, None))
        several = np.minimum(counts[a:b][~single], MOST).astype(np.uint32)
        rows.append((p, 1, None, len(ones), _squeezed(ones), len(more), _squeezed(more), several.tobytes()))
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _PACKED)


class Summary:
    """A Misra-Gries summary of at most ``capacity`` counters between two calls of :meth:`settle`."""

    def __init__(self, capacity: int, buffer: int = 1 << 20):
        self.capacity, self.buffer = capacity, max(buffer, capacity)
        self.values, self.counts = np.empty(0, np.uint32), np.empty(0, np.uint32)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        #: What decrements have taken from a counter at most.
        self.lost = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((values, counts))
        self.held += len(values)
        if self.held > self.buffer:
            self.settle()

    def settle(self) -> None:
        """Equal values are added up; if too many are left, all lose what the largest one too many has."""
        values = np.concatenate([self.values, *(v for v, _ in self.waiting)]).astype(np.uint64)
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)]).astype(np.uint64)
        # Value and count in one number: a plain sort brings equal values together.
        both = np.sort(values << np.uint64(32) | counts)
        values = (both >> np.uint64(32)).astype(np.uint32)
        begin = np.flatnonzero(np.diff(values, prepend=values[:1] ^ np.uint32(1)))
        sums = np.add.reduceat(both & np.uint64(0xFFFFFFFF), begin) if len(both) else both
        values, counts = values[begin], np.minimum(sums, MOST).astype(np.uint32)
        self.waiting, self.held = [], 0
        if len(values) > self.capacity:
            place = len(values) - self.capacity - 1
            least = np.partition(counts, place)[place]
            self.lost += int(least)
            left = counts > least
            values, counts = values[left], counts[left] - least
        self.values, self.counts = values, counts

    def survivors(self, threshold: int) -> np.ndarray:
        """Every value of at least ``threshold`` occurrences, and some of fewer."""
        self.settle()
        return self.values[self.counts.astype(np.int64) + self.lost >= threshold]


def _slice(low: np.ndarray, size: int) -> bytes:
    """The bits of a partition's survivors: its slice, of ``2 ** size`` bits, of the map."""
    bits = np.zeros(1 << size, np.uint8)
    bits[low >> np.uint32(32 - size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _summarised(threshold: int, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def finished() -> pa.RecordBatch:
            bits = _slice(summary.survivors(threshold), size)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([bits], pa.binary())], ["part", "bits"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if summary is not None:
                        yield finished()
                    part, mass, summary = row["part"], 0, None
                if row["kind"] == 0:
                    mass += row["mass"]
                    continue
                if summary is None:
                    summary = Summary(mass // threshold + 1)
                ones = _unsqueezed(row["ones"], row["n_ones"])
                summary.add(ones, np.ones(len(ones), np.uint32))
                summary.add(_unsqueezed(row["more"], row["n_more"]), np.frombuffer(row["counts"], np.uint32))
        if summary is not None:
            yield finished()

    return work


def survivors(texts: DataFrame, longest: int, threshold: int, power: int, bits_power: int, flush: int) -> bytes:
    """The map of phrases of up to ``longest`` words that may have ``threshold`` occurrences.

    One shuffle of packed counters by hash partition, each of which gives its slice of the map; the slices,
    ``2 ** bits_power`` bits in all, come to the driver.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for words, codes, *_ in _texts(batches):
            for n in range(1, longest + 1):
                waiting.append(words.phrases(n, codes, words.whole(n)))
                held += len(waiting[-1])
            if held > flush:
                yield _packed(np.concatenate(waiting), power)
                waiting, held = [], 0
        if held:
            yield _packed(np.concatenate(waiting), power)

    types = ("long", "int", "long", "long", "binary", "long", "binary", "binary")
    counted = texts.mapInArrow(work, ", ".join(f"{n} {t}" for n, t in zip(_PACKED, types, strict=True)))
    # Masses come before counters.
    dealt = counted.repartition("part").sortWithinPartitions("part", "kind")
    found = dealt.mapInArrow(_summarised(threshold, bits_power - power), "part long, bits binary")
    whole = bytearray((1 << bits_power) // 8)
    width = len(whole) >> power
    # A fixed number of bits in all.
    for part, bits in found.collect():
        whole[part * width : (part + 1) * width] = bits
    return bytes(whole)


def _counted(held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array, np.ndarray]], power: int) -> pa.RecordBatch:
    """Equal phrases of some steps added up: one row per hash partition, with lists of phrases."""
    hashes, counts, sizes = (np.concatenate([h[i] for h in held]) for i in (0, 1, 4))
    langs, phrases = (pa.chunked_array([h[i] for h in held]).combine_chunks() for i in (2, 3))
    order = np.argsort(hashes)
    begin = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]))
    sums = np.add.reduceat(counts[order], begin)
    first = order[begin]
    parts = list(_parts(hashes[first], power))
    offsets = pa.array([0] + [b for _, _, b in parts], pa.int32())
    lists = [langs.take(pa.array(first)), pa.array(sizes[first], pa.int32()), phrases.take(pa.array(first)).cast(pa.string()), pa.array(sums, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in parts], pa.int64()), *(pa.ListArray.from_arrays(offsets, x) for x in lists)], ["part", *_COUNTED]
    )


def _added(threshold: int):
    """Adds up the blocks of each hash partition; phrases of fewer occurrences end here."""

    def added(blocks: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(blocks).group_by(_COUNTED[:3]).aggregate([("a", "sum")]).select([*_COUNTED[:3], "a_sum"]).rename_columns(_COUNTED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, rows = None, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            yield from added(blocks).filter(pc.field("a") >= threshold).to_batches()

        for batch in batches:
            for row in range(batch.num_rows):
                own = batch.column(0)[row].as_py()
                if own != part:
                    if blocks:
                        yield from finished()
                    part, blocks, rows = own, [], 0
                blocks.append(pa.table([batch.column(i)[row].values for i in range(1, 5)], names=_COUNTED))
                rows += blocks[-1].num_rows
                if rows > 4 * blocks[0].num_rows + MERGED:
                    blocks = [added(blocks)]
                    rows = blocks[0].num_rows
        if blocks:
            yield from finished()

    return work


def phrase_counts(texts: DataFrame, bits: bytes, longest: int, threshold: int, power: int, flush: int) -> DataFrame:
    """``lang, size, phrase, a``: the phrases with at least ``threshold`` occurrences whose bit is set, counted exactly.

    Size 0 counts all words of a language. Tasks add up equal phrases and send them as blocks by hash partition.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits, np.uint8)
        held, count = [], 0
        for words, codes, langs, own in _texts(batches):
            names = langs.cast(pa.string())
            which, totals = np.unique(own[words.row], return_counts=True)
            of_lang = np.zeros(len(names), np.uint64)
            of_lang[own] = codes
            held.append((of_lang[which], totals, names.take(pa.array(which)), pa.array([""] * len(which), pa.large_string()), np.zeros(len(which), np.int32)))
            for n in range(1, longest + 1):
                at = words.whole(n)
                hashes = words.phrases(n, codes, at)
                marked = _set(known, hashes)
                hashes, place, counts = np.unique(hashes[marked], return_index=True, return_counts=True)
                at = at[marked][place]
                held.append((hashes, counts, names.take(pa.array(own[words.row[at]])), words.texts(n, at), np.full(len(at), n, np.int32)))
                count += len(at)
            if count > flush:
                yield _counted(held, power)
                held, count = [], 0
        if held:
            yield _counted(held, power)

    lists = "part long, lang array<string>, size array<int>, phrase array<string>, a array<long>"
    dealt = texts.mapInArrow(work, lists).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(_added(threshold), "lang string, size int, phrase string, a long")


def collocations(
    documents: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    most: int = 2000,
    bits_power: int = BITS,
    flush: int = FLUSH,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``most`` phrases.

    Phrases of two to ``longest`` words, within a piece of text, with ``a >= threshold`` occurrences. Cut after its first
    words, a phrase has parts of ``l`` and ``r`` occurrences; its score is the least ``1000 * a * n div (l * r)`` of its
    cuts, of equal ones the first. Phrases that occur only inside a longer one of the list are left out. A null
    language is ``und``; null and empty texts have no words; repeated rows count each. An empty table gives no rows.
    """
    texts = documents.select("text", "lang")
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # A slice of the map has a whole byte at least.
    power = min(max(LEAST, (size // PARTITION_BYTES).bit_length()), bits_power - 3)
    bits = survivors(texts, longest, threshold, power, bits_power, flush)
    counted = _stored(phrase_counts(texts, bits, longest, threshold, power, flush // 4), "phrases")
    # One row per language; a language of fewer words has no phrase.
    totals = broadcast_if_small(counted.where("size = 0").select(F.col("lang").alias("_lang"), F.col("a").alias("n")))

    parts = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice(parts, 1, k), " ").alias("head"), F.array_join(F.slice(parts, k + 1, F.col("size")), " ").alias("tail")),
    )
    cut = counted.where("size > 1").select("lang", "size", "phrase", "a", F.inline(cuts))
    of = counted.where("size > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("a").alias("_a"))
    held = cut.join(of, [F.col("lang") == F.col("_lang"), F.col("head") == F.col("_phrase")])
    held = held.select("lang", "size", "phrase", "a", "k", "head", "tail", F.col("_a").alias("l"))
    held = held.join(of, [F.col("lang") == F.col("_lang"), F.col("tail") == F.col("_phrase")])
    held = _stored(held.select("lang", "size", "phrase", "a", "k", "head", "tail", "l", F.col("_a").alias("r")), "cuts")

    # A phrase that is inside a longer one every time is so in one of one word more.
    inside = held.where("k = size - 1 AND l = a").select("lang", F.col("head").alias("phrase"))
    inside = inside.union(held.where("k = 1 AND r = a").select("lang", F.col("tail").alias("phrase"))).distinct()

    # 1000 * a * n has up to 38 digits; the quotient is at most 1000 * n.
    score = F.expr("cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))")
    scored = held.join(totals, F.col("lang") == F.col("_lang")).withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(
        F.min("a").alias("a"), F.min("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    kept = best.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "n", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


COLLOCATION_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size)
    GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT g.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, size)) AS k FROM grams WHERE size > 1) g
), scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, k, h.a AS l, t.a AS r, n, (1000 * c.a::HUGEINT * n) // (h.a::HUGEINT * t.a) AS score
    FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = head JOIN grams t ON t.lang = c.lang AND t.phrase = tail
    JOIN totals ON totals.lang = c.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM best s WHERE NOT EXISTS (
        SELECT 1 FROM grams b WHERE b.lang = s.lang AND b.size > s.size AND b.a >= s.a AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r,
    n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
