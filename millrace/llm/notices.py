"""License notices by fuzzy search: exact seeds propose places, bounded-error matching decides.

A notice of which at most ``edits`` bytes may differ is split into ``edits + 1`` pieces. By the pigeonhole principle
every run of words within that distance holds one piece unchanged, at most ``edits`` bytes away from its place in
the notice. One Aho-Corasick automaton over all pieces finds these seeds in the normalised text (see
:func:`millrace.llm.decontaminate.normalised`), and each run of whole words that fits around a seed is matched with
the notice's bounded-error pattern. A run must also hold the notice's core word unchanged: one edit parts "version 2"
from "version 3", and two part MIT from MPL.
"""

from __future__ import annotations

import bisect
import functools
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.decontaminate import normalised, word_spans
from millrace.llm.text import by_batch

#: A notice may differ in one byte for each ``EDIT_BYTES`` of its own.
EDIT_BYTES = 10
#: Distances that a worker remembers, by notice and run; emptied of the oldest when full.
REMEMBERED = 1 << 16


@dataclass(frozen=True)
class Notice:
    """A short notice in normalised form, the license it stands for, and the word that must be unchanged."""

    label: str
    text: str
    core: str
    base: bool = False
    edits: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "edits", len(self.text) // EDIT_BYTES)


#: The base phrases, then other short notices.
NOTICES = (
    Notice("mit", "under the mit license", "mit", True),
    Notice("apache-2", "apache license version 2", "2", True),
    Notice("cc-by-nc", "cc by nc", "nc", True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", "granted"),
    Notice("gpl-3", "gnu general public license version 3", "3"),
    Notice("gpl-2", "gnu general public license version 2", "2"),
    Notice("lgpl", "gnu lesser general public license", "lesser"),
    Notice("agpl-3", "gnu affero general public license version 3", "3"),
    Notice("bsd", "redistribution and use in source and binary forms", "redistribution"),
    Notice("mpl-2", "mozilla public license version 2", "2"),
    Notice("epl-2", "eclipse public license version 2", "2"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", "distribute"),
    Notice("unlicense", "free and unencumbered software released into the public domain", "unencumbered"),
    Notice("cc-by", "creative commons attribution license", "attribution"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", "noncommercial"),
    Notice("cc-by-sa", "creative commons attribution sharealike", "sharealike"),
    Notice("all-rights-reserved", "all rights reserved", "rights"),
)


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """Place and text of the ``edits + 1`` nearly equal pieces of a notice."""
    cuts = [len(notice.text) * i // (notice.edits + 1) for i in range(notice.edits + 2)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Seeds, patterns and remembered distances of some notices; built once per Python worker and call."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.built = None

    def _build(self) -> None:
        held: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for place, piece in pieces(notice):
                held.setdefault(piece, []).append((number, place))
        self.built = ahocorasick.Automaton()
        for piece, owners in held.items():
            self.built.add_word(piece, (len(piece), owners))
        self.built.make_automaton()
        patterns = [regex.compile(f"(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in self.notices]

        @functools.lru_cache(REMEMBERED)
        def distance(number: int, run: str) -> int | None:
            """Fewest edits between a run of words and a notice, or None beyond what it may have."""
            notice = self.notices[number]
            if run == notice.text:
                return 0
            if notice.core not in run.split(" "):
                return None
            if not patterns[number].fullmatch(run):
                return None
            # The pattern that still matches with fewer errors has the distance.
            return next(e for e in range(1, notice.edits + 1) if e == notice.edits or within(number, e).fullmatch(run))

        @functools.cache
        def within(number: int, edits: int):
            return regex.compile(f"(?:{regex.escape(self.notices[number].text)}){{e<={edits}}}")

        self.distance = distance

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int, int]]]:
        """Number of words, and (notice, first word, words, edits) of each run within its notice's distance."""
        if self.built is None:
            self._build()
        found = normalised(text).split()
        joined = b" ".join(found).decode("latin-1")
        seeds = set()
        for end, (length, owners) in self.built.iter(joined):
            seeds.update((number, end + 1 - length - place) for number, place in owners)
        if not seeds:
            return len(found), []
        # Where each word starts; one more entry for the end.
        spaces = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
        starts = [0, *(spaces + 1).tolist(), len(joined) + 1]
        runs = {}
        for number, place in seeds:
            notice = self.notices[number]
            slack = notice.edits
            first = bisect.bisect_left(starts, place - slack, 0, len(found))
            for a in range(first, bisect.bisect_right(starts, place + slack, first, len(found))):
                low = starts[a]
                # A run of words from ``a`` ends one byte before the start of the next word.
                shortest = low + len(notice.text) - slack + 1
                end = bisect.bisect_left(starts, shortest, a + 1)
                for b in range(end, bisect.bisect_right(starts, shortest + 2 * slack, end)):
                    if (number, a, b - a) not in runs:
                        runs[number, a, b - a] = self.distance(number, joined[low : starts[b] - 1])
        return len(found), sorted((*run, edits) for run, edits in runs.items() if edits is not None)


def _apart(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of each notice's overlapping runs, sorted by place, the one with the fewest edits."""
    out: list[tuple[int, int, int, int]] = []
    for run in runs:
        if out and out[-1][0] == run[0] and run[1] < out[-1][1] + out[-1][2]:
            if run[3] < out[-1][3]:
                out[-1] = run
        else:
            out.append(run)
    return out


def license_scan(documents: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Per document: its words, base places and labels, all labels, a score and the notices' spans.

    Columns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels`` (sorted arrays), ``score`` (the
    closest notice's share of bytes without an edit, 0 without any) and ``spans`` (array of ``{label, start, end,
    edits}``: code points of the original text, end exclusive; of runs of one notice that overlap the closest).
    Base places are the runs of a base notice without an edit, overlapping ones too. Null and empty texts have
    no words and no labels; repeated rows are scanned each, and an empty table gives no rows.
    """
    scanner = Scanner(tuple(notices))
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])

    def one(text: str | None) -> tuple:
        encoded = (text or "").encode()
        n, runs = scanner.scan(encoded)
        if not runs:
            return n, 0, None, None, [], [], 0.0, []
        base = [(notices[k].label, a) for k, a, _, edits in runs if notices[k].base and not edits]
        at = word_spans(encoded)
        # Code points that begin before each byte.
        points = np.concatenate([[0], np.cumsum(np.frombuffer(encoded, np.uint8) & 0xC0 != 0x80)])
        spans = [
            {"label": notices[k].label, "start": int(points[at[a, 0]]), "end": int(points[at[a + words - 1, 1]]), "edits": edits}
            for k, a, words, edits in _apart(runs)
        ]
        places = [a for _, a in base]
        return (
            n,
            len(base),
            min(places, default=None),
            max(places, default=None),
            sorted({label for label, _ in base}),
            sorted({notices[k].label for k, *_ in runs}),
            max(round(1 - edits / len(notices[k].text), 6) for k, _, _, edits in runs),
            sorted(spans, key=lambda s: (s["start"], s["end"], s["label"])),
        )

    types = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64(), pa.list_(span)]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(text) for text in batch.column(1).to_pylist()]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", *names]
        )

    return by_batch(
        documents.select("doc_id", "text"),
        work,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double, spans array<struct<label: string, start: long, end: long, edits: int>>",
    )


def report(documents: DataFrame) -> DataFrame:
    """:func:`license_scan` with the labels as text."""
    found = license_scan(documents)
    joined = {name: F.array_join(name, ",") for name in ("base_labels", "labels")}
    return found.withColumns(joined).drop("spans")


_CASES = ",\n    ".join(
    f"({i}, '{n.label}', '{n.text}', '{n.core}', {n.base}, {n.edits})" for i, n in enumerate(NOTICES)
)

#: Every run of words around a core word, by plain edit distance; no seeds.
LICENSE_SQL = rf"""
WITH notices(notice, label, notice_text, core, base, edits) AS (VALUES
    {_CASES}
), texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), cores AS (
    SELECT r, p, n.* FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts) t
    JOIN notices n ON t.word = n.core
), runs AS (
    SELECT DISTINCT c.* EXCLUDE (p), first_place, run_words, array_to_string(w[first_place:first_place + run_words - 1], ' ') AS run
    FROM (
        SELECT *, unnest(range(greatest(1, p - run_words + 1), p + 1)) AS first_place
        FROM (SELECT *, unnest(range(greatest(1, len(string_split(notice_text, ' ')) - edits),
            len(string_split(notice_text, ' ')) + edits + 1)) AS run_words FROM cores)
    ) c JOIN texts USING (r) WHERE first_place + run_words - 1 <= len(w)
), met AS (
    SELECT r, label, base AND run = notice_text AS is_base, first_place - 1 AS place, notice,
        round(1 - levenshtein(run, notice_text) / strlen(notice_text), 6) AS score
    FROM runs WHERE abs(strlen(run) - strlen(notice_text)) <= edits AND levenshtein(run, notice_text) <= edits
), sums AS (
    SELECT r, count(*) FILTER (is_base) AS n_base, min(place) FILTER (is_base) AS first_word,
        max(place) FILTER (is_base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM met GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN sums USING (r)
"""
