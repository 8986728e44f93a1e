"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are trigrams of character classes, hashed words, and marks of repetition. Their weighted counts
over a bounded sample of labelled texts are decomposed (truncated SVD); the projection and the labelled vectors
are the model, a few megabytes whatever the corpus. Every text is projected and compared with all labelled
vectors by blocked matrix products; the nearest ones vote with weights that grow with their cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import by_batch, held_out, labelled_sample, steps, text_bytes, words

#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 6000
DIMENSIONS = 64
NEIGHBOURS = 15
#: Texts in one matrix product.
BLOCK = 256

_CLASSES = 12
_WORD_TERMS = 512
_MARKS = 48
TERMS = _CLASSES**3 + _WORD_TERMS + _MARKS

_CLASS = np.full(256, 9, np.int64)  # other ASCII punctuation
_CLASS[97:123] = 0
_CLASS[128:] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 11, 12]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[46, 44, 59, 58]] = 5
_CLASS[[33, 63]] = 6
_CLASS[[35, 36, 37, 38, 42]] = 7
_CLASS[[124, 60, 62, 47, 92, 95, 61]] = 8
_CLASS[[39, 34, 40, 41, 45]] = 10
_CLASS[:9] = 11


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of terms, one line per text; texts without bytes have zeros."""
    rows = len(offsets) - 1
    out = np.zeros((rows, TERMS), np.float32)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    kind = _CLASS[data]
    if len(data) > 2:
        inside = row[:-2] == row[2:]
        gram = (kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:]
        counts = np.bincount((row[:-2] * _CLASSES**3 + gram)[inside], minlength=rows * _CLASSES**3)
        out[:, : _CLASSES**3] = counts.reshape(rows, -1)
    word, owner = words(data, offsets)
    at = _CLASSES**3
    term = (word >> np.uint64(40)).astype(np.int64) % _WORD_TERMS
    out[:, at : at + _WORD_TERMS] = np.bincount(owner * _WORD_TERMS + term, minlength=rows * _WORD_TERMS).reshape(rows, -1)
    at += _WORD_TERMS
    # Marks of repetition: shares in steps, each a term of its own.
    count = np.bincount(owner, minlength=rows)
    order = np.lexsort((word, owner))
    sorted_word, sorted_owner = word[order], owner[order]
    fresh = np.ones(len(word), bool)
    fresh[1:] = (sorted_word[1:] != sorted_word[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    distinct = np.bincount(sorted_owner[fresh], minlength=rows)
    repeated = np.zeros(len(word), bool)
    repeated[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner[repeated], minlength=rows)
    some = np.flatnonzero(count)
    n = count[some].astype(float)
    length = np.minimum(np.log2(n).astype(int), 15)
    # Compared with what a text of that length has by chance.
    unique = np.minimum((distinct[some] / np.minimum(n, 60 + n**0.85) * 12).astype(int), 15)
    twice = np.minimum((again[some] / n * 15).astype(int), 15)
    weight = np.diff(offsets)[some] / 8.0
    for k, mark in enumerate((length, unique, twice)):
        out[some, at + 16 * k + mark] = weight
    return out


@dataclass
class Model:
    """The fitted projection and the labelled vectors."""

    inverse_frequency: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        vectors = weighted(counts, self.inverse_frequency) @ self.projection
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.share)
        out = np.empty(len(counts))
        near = min(NEIGHBOURS, len(self.labels))
        for start in range(0, len(counts), BLOCK):
            part = counts[start : start + BLOCK]
            cosine = self.project(part) @ self.vectors.T
            best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            weight = np.exp(12.0 * (np.take_along_axis(cosine, best, 1).astype(float) - 1))
            # The sample's share counts as a distant neighbour: it decides where nothing is near.
            out[start : start + BLOCK] = ((weight * self.labels[best]).sum(1) + 1e-3 * self.share) / (weight.sum(1) + 1e-3)
        return np.clip(out, 0.0, 1.0)


def weighted(counts: np.ndarray, inverse_frequency: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1, keepdims=True)
    scaled = np.log1p(counts * (400.0 / np.maximum(total, 1))) * inverse_frequency
    return (scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def all_counts(column: pa.Array):
    data, offsets = text_bytes(column)
    for low, high in steps(offsets):
        yield term_counts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model on at most ``rows`` labelled texts; without any, every score is 0.5."""
    sample = labelled_sample(documents, labels, label, rows)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [line for counts in all_counts(batch.column(0)) for line in counts]
        parts = [np.flatnonzero(line) for line in lines]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())),
                pa.array([line[p] for line, p in zip(lines, parts, strict=True)], pa.list_(pa.float32())),
                batch.column(1),
            ],
            ["terms", "counts", "label"],
        )

    # Bounded: ``rows`` sparse lines.
    fitted = by_batch(sample, work, "terms array<int>, counts array<float>, label int").toArrow()
    n = fitted.num_rows
    marks = np.array(fitted["label"].to_pylist(), float)
    if not n:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), marks, 0.5)
    counts = np.zeros((n, TERMS), np.float32)
    for k, (terms, values) in enumerate(zip(fitted["terms"], fitted["counts"], strict=True)):
        counts[k, terms.values.to_numpy()] = values.values.to_numpy()
    frequency = (counts > 0).sum(axis=0)
    inverse = (np.log((1 + n) / (1 + frequency)) + 0.3).astype(np.float32)
    lines = weighted(counts, inverse)
    _, vectors = np.linalg.eigh((lines.T @ lines).astype(np.float64))
    projection = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    model = Model(inverse, projection, np.zeros((0, 1), np.float32), marks, float(marks.mean()))
    model.vectors = model.project(counts)
    return model


def quality_scores(documents: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null and empty texts have no terms; their vector is zero, at cosine 0 from every labelled vector, so their
    score is near the vote of all. Repeated rows score alike. Without usable labels every score is 0.5.
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, label))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [s for counts in all_counts(batch.column(1)) for s in model.value.scores(counts)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = by_batch(documents.select("doc_id", "text"), work, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
