"""The blocked vote against a plain one, document by document."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(11)
    kinds = [["the", "quiet", "river", "ran", "over", "stones"], ["BUY", "now!!", "$$$", "click", "win"], ["el", "niño", "corrió", "río"]]
    texts = [" ".join(rng.choices(rng.choice(kinds), k=rng.randint(1, 60))) for _ in range(240)] + [None, "", "   ", "x" * 5000]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("$" in (t or "") or "río" in (t or ""))) for i, t in enumerate(texts)], "doc_id long, quality int")
    return texts, documents, labels


def plain_vote(model, vector) -> float:
    cosines = [sum(float(a) * float(b) for a, b in zip(vector, other, strict=True)) for other in model.vectors]
    nearest = sorted(range(len(cosines)), key=lambda k: -cosines[k])[: quality.NEIGHBOURS]
    weights = [math.exp(12 * (cosines[k] - 1)) for k in nearest]
    for_one = sum(w for w, k in zip(weights, nearest, strict=True) if model.labels[k] == 1)
    return (for_one + 1e-3 * model.share) / (sum(weights) + 1e-3)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_scores_equal_a_plain_vote(case, monkeypatch, block):
    texts, documents, labels = case
    model = quality.fit(documents, labels)
    assert len(model.labels) > 150 and 0 < model.share < 1
    monkeypatch.setattr(quality, "BLOCK", block)
    counts = np.concatenate(list(quality.all_counts(pa.array(texts, pa.string()))))
    expected = [plain_vote(model, v) for v in model.project(counts)]
    assert model.scores(counts) == pytest.approx(expected, abs=2e-4)


def test_the_query_scores_like_its_model(case):
    texts, documents, labels = case
    model = quality.fit(documents, labels)
    counts = np.concatenate(list(quality.all_counts(pa.array(texts, pa.string()))))
    expected = model.scores(counts)
    found = {r["doc_id"]: r for r in quality.quality_scores(documents, labels).collect()}
    assert len(found) == len(texts)
    for i, score in enumerate(expected):
        assert found[i]["score"] == pytest.approx(score, abs=1e-5)
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.3)
