"""Toxicity: Levenshtein automata intersected with a lexicon trie, and scores of context windows.

The lexicon is learned from a bounded sample of labelled texts: words, and stems of words, that toxic texts
hold far more often than others. It lies in a trie. A token is read by the intersection of that trie with the
automaton of all strings within some edits of its entries; the states of the intersection are made when first
met and kept in a bounded table. Each hit is weighed by how its entry, exact or misspelled, was spread over the
sample, and by the window of tokens around it: between quotation marks or beside a verb of saying it counts as
quotation. A logistic model of the window sums gives the score.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import by_batch, held_out, labelled_sample
from millrace.session import scratch_path

#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 10_000
LEXICON_ROWS = 2_000
SHORTEST, LONGEST = 4, 24
#: An entry is in at least this share of the sample's toxic texts; rarer words are marks of copied texts.
LEAST_SHARE = 0.01
#: Tokens on each side of a hit that make its window.
WINDOW = 6
TABLE_ROWS = 300_000

#: Fixed values.
QUOTES = frozenset("\"“”„«»‹›‟")
STRIP = " \t\n.,;:!?()[]{}<>\"'`´“”„«»‹›‟’‘*#%&$|/\\~^+=-_…"
SAYING = frozenset(
    "said says saying quote quoted quotes quoting wrote writes called calls word words term phrase "
    "sagte sagt schrieb nannte zitat zitiert wort dijo dice escribió llamó cita palabra dit disait écrit appelé cite mot".split()
)


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


class Automaton:
    """The intersection of a lexicon trie with the Levenshtein automata of its entries.

    A state is a set of (trie node, edits); entries are words, matched whole, or stems (``*`` at the end), matched
    at the beginning of a token.
    """

    def __init__(self, entries: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.word: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most = [0]
        for entry in entries:
            letters = entry.rstrip("*")
            allowed = edits_allowed(len(letters))
            node = 0
            self.most[0] = max(self.most[0], allowed)
            for letter in letters:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.next[node][letter]
                self.most[node] = max(self.most[node], allowed)
            if entry.endswith("*"):
                self.stem[node] = entry
            else:
                self.word[node] = entry
        self.clear()

    def clear(self) -> None:
        self.known: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.found_stem: list[tuple[str, int] | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, items: set[tuple[int, int]]) -> int:
        """The number of a state, with skipped letters of the entries (deletions) followed."""
        best: dict[int, int] = {}
        todo = list(items)
        while todo:
            node, edits = todo.pop()
            if edits > self.most[node] or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            todo.extend((child, edits + 1) for child in self.next[node].values())
        key = frozenset(best.items())
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.found.append(self._best(self.word, best))
            self.found_stem.append(self._best(self.stem, best))
        return self.known[key]

    def _best(self, names: list[str | None], best: dict[int, int]) -> tuple[str, int] | None:
        hits = [(e, names[n]) for n, e in best.items() if names[n] and e <= edits_allowed(len(names[n].rstrip("*")))]
        return (min(hits)[1], min(hits)[0]) if hits else None

    def _move(self, state: int, letter: str) -> int:
        items: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            items.add((node, edits + 1))  # the letter is one too many
            for own, child in self.next[node].items():
                items.add((child, edits + (own != letter)))
        return self._state(items)

    def match(self, token: str) -> tuple[str, int] | None:
        """The nearest entry and its edits; words before stems at equal edits; None if all are too far."""
        state, stem = self.start, None
        dead = self.known.get(frozenset())
        for letter in token:
            state_moves = self.moves[state]
            if letter in state_moves:
                state = state_moves[letter]
            else:
                state = state_moves[letter] = self._move(state, letter)
                dead = self.known.get(frozenset())
            hit = self.found_stem[state]
            if hit is not None and (stem is None or hit[1] < stem[1]):
                stem = hit
            if state == dead:
                return stem
        hit = self.found[state]
        return stem if hit is None or stem is not None and stem[1] < hit[1] else hit


class Scorer:
    """The fitted lexicon, weights and logistic model; counts and scores texts."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.weights: dict[tuple[str, int], float] = {}
        self.default = [0.0] * 3
        self.model: np.ndarray | None = None
        self.share = 0.5
        self.automaton: Automaton | None = None
        self.table: dict[str, tuple[str, int] | None] = {}

    def __getstate__(self):
        return self.__dict__ | {"automaton": None, "table": {}}

    def lookup(self, token: str) -> tuple[str, int] | None:
        if token in self.table:
            return self.table[token]
        if self.automaton is None:
            self.automaton = Automaton(self.entries)
        if len(self.table) >= TABLE_ROWS:
            self.table.clear()
        if len(self.automaton.sets) >= TABLE_ROWS:
            self.automaton.clear()
        plain = token.strip(STRIP)
        hit = self.automaton.match(plain) if len(plain) >= SHORTEST - 1 else None
        self.table[token] = hit
        return hit

    def hits(self, text: str | None) -> list[tuple[int, str, int, bool]]:
        """(token number, entry, edits, quoted) of each hit."""
        tokens = (text or "").lower().split()
        lookup = self.lookup
        found = {t: hit for t in set(tokens) if (hit := lookup(t)) is not None}
        if not found:
            return []
        out = []
        for k, token in enumerate(tokens):
            if token in found:
                before, after = tokens[max(0, k - WINDOW) : k], tokens[k + 1 : k + 1 + WINDOW]
                opened = any(c in QUOTES for t in before for c in t) or token[0] in QUOTES
                closed = any(c in QUOTES for t in after for c in t) or token[-1] in QUOTES or token.rstrip(".,;:!?")[-1:] in QUOTES
                said = any(t.strip(STRIP) in SAYING for t in before)
                out.append((k, *found[token], opened and closed or said and (opened or closed)))
        return out

    def weight(self, entry: str, edits: int) -> float:
        return self.weights.get((entry, edits), self.default[min(edits, 2)])

    def features(self, text: str | None) -> list[float]:
        """Window sums: abuse and quotation, exact and misspelled; the densest window; a constant."""
        sums = [0.0] * 4
        densest = 0.0
        recent: list[tuple[int, float]] = []
        for k, entry, edits, quoted in self.hits(text):
            w = self.weight(entry, edits)
            sums[2 * (edits > 0) + quoted] += w
            recent = [(at, v) for at, v in recent if k - at <= 2 * WINDOW]
            recent.append((k, w * (0.2 if quoted else 1.0)))
            densest = max(densest, sum(v for _, v in recent))
        return [*(min(max(s, -12.0), 12.0) / 4 for s in sums), min(max(densest, -12.0), 12.0) / 4, 1.0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model is None:
            return np.full(len(texts), self.share)
        lines = np.array([self.features(t) for t in texts], float).reshape(-1, 6)
        return 1 / (1 + np.exp(-lines @ self.model))


def _lexicon_counts(sample: DataFrame) -> DataFrame:
    """Toxic and other texts that hold each word (``word$``) and each beginning of a word."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held = set()
            for token in set((text or "").lower().split()):
                plain = token.strip(STRIP)
                if SHORTEST <= len(plain) <= LONGEST and plain.isalpha():
                    held.update(plain[:n] for n in range(SHORTEST, len(plain) + 1))
                    held.add(plain + "$")
            for name in held:
                counts[name][label] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()), pa.array([c[0] for c in counts.values()], pa.int64())],
            ["name", "toxic", "other"],
        )

    return by_batch(sample, work, "name string, toxic long, other long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _strength(toxic: float, other: float, toxic_rows: int, other_rows: int) -> float:
    """A lower bound of the log odds ratio."""
    odds = math.log((toxic + 0.5) / (toxic_rows + 1)) - math.log((other + 0.5) / (other_rows + 1))
    return odds - 1.5 * math.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))


def choose_entries(counts: dict[str, tuple[int, int]], toxic_rows: int, other_rows: int, least: float = 2.0) -> list[str]:
    """Words and stems that are strong alone: the shortest strong beginnings, each made as long as its texts allow."""
    enough = max(4, LEAST_SHARE * toxic_rows)
    strong = {n for n, (t, o) in counts.items() if t >= enough and _strength(t, o, toxic_rows, other_rows) >= least}
    children: dict[str, list[str]] = defaultdict(list)
    for name in counts:
        children[name[:-1]].append(name)
    entries = set()
    for name in sorted(strong, key=len):
        if any(name[:n] in strong for n in range(SHORTEST, len(name))):
            continue
        while True:
            longer = [c for c in children[name] if counts[c][0] >= 0.9 * counts[name][0]] if not name.endswith("$") else []
            if not longer:
                break
            name = max(longer, key=lambda c: (counts[c][0], c.endswith("$"), c))
        entries.add(name[:-1] if name.endswith("$") else name + "*")
    return sorted(entries)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Scorer:
    """Fits lexicon and model on at most ``rows`` labelled texts; without any, every score is 0.5."""
    spark = documents.sparkSession
    path = scratch_path(spark, "toxicity-sample")
    # A text that many rows repeat says no more than once.
    labelled_sample(documents, labels, label, rows).groupBy("text").agg(F.max("label").alias("label")).write.parquet(path)
    sample = spark.read.schema("text string, label int").parquet(path).repartition(8)
    sizes = Counter({r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()})
    toxic_rows, other_rows = sizes[1], sizes[0]
    if not toxic_rows + other_rows:
        return Scorer([])
    ratio = F.col("toxic") / (F.col("other") + 1)
    # Bounded: the strongest names of a bounded sample.
    likely = _lexicon_counts(sample).where((F.col("toxic") >= 3) & (F.col("toxic") * (other_rows + 1) > 3 * F.col("other") * (toxic_rows + 1)))
    likely = likely.orderBy(ratio.desc(), F.length("name"), "name").limit(20 * LEXICON_ROWS)
    counts = {r["name"]: (r["toxic"], r["other"]) for r in likely.collect()}
    strength = lambda e: _strength(*counts.get(e.rstrip("*") + "$" * (not e.endswith("*")), (0, 0)), toxic_rows, other_rows)
    entries = sorted(choose_entries(counts, toxic_rows, other_rows), key=lambda e: (-strength(e), e))[:LEXICON_ROWS]
    scorer = Scorer(sorted(entries))
    scorer.share = toxic_rows / (toxic_rows + other_rows)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = Counter()
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.update({(entry, edits, label) for _, entry, edits, _ in scorer.hits(text)})
        keys = list(counts)
        columns = [pa.array([k[i] for k in keys], t) for i, t in ((0, pa.string()), (1, pa.int32()), (2, pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], ["entry", "edits", "label", "n"])

    # At most a few rows per entry of the lexicon.
    spreads = by_batch(sample, spread, "entry string, edits int, label int, n long").groupBy("entry", "edits", "label").agg(F.sum("n").alias("n"))
    by_hit: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0, 0])
    pooled = [[0, 0] for _ in range(3)]
    for r in spreads.collect():
        by_hit[r["entry"], r["edits"]][r["label"]] += r["n"]
        pooled[min(r["edits"], 2)][r["label"]] += r["n"]
    scorer.weights = {k: _strength(t, o, toxic_rows, other_rows) for k, (o, t) in by_hit.items()}
    scorer.default = [0.5 * _strength(t, o, toxic_rows, other_rows) for o, t in pooled]

    def lines(batch: pa.RecordBatch) -> pa.RecordBatch:
        features = [scorer.features(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(features, pa.list_(pa.float64())), batch.column(1)], ["features", "label"])

    # Bounded: six numbers per row of the sample.
    table = by_batch(sample, lines, "features array<double>, label int").toArrow()
    scorer.model = logistic(np.array(table["features"].to_pylist(), float), np.array(table["label"].to_pylist(), float))
    return scorer


def logistic(lines: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton's method, drawn towards abuse counting fully and quotation little."""
    centre = np.array([2.0, 0.4, 2.0, 0.4, 1.0, -2.5])
    beta = centre.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-lines @ beta))
        gradient = lines.T @ (labels - p) - ridge * (beta - centre)
        hessian = (lines * (p * (1 - p))[:, None]).T @ lines + ridge * np.eye(len(beta))
        move = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def toxicity_scores(documents: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null and empty texts have no hits and get the score of a text without hits. Repeated rows score alike.
    Without usable labels every score is 0.5.
    """
    scorer = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, label))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = scorer.value.scores(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = by_batch(documents.select("doc_id", "text"), work, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score stays below ``threshold``; all of them if no label is usable."""
    fitted = fit(documents, labels, label)
    if fitted.model is None:
        return documents
    scorer = documents.sparkSession.sparkContext.broadcast(fitted)
    place = documents.columns.index("text")

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(scorer.value.scores(batch.column(place).to_pylist()) < threshold))

    return documents.mapInArrow(work, documents.schema)
