"""A benchmark of many automata, and automata kept by the worker."""

from __future__ import annotations

import random

import pyarrow as pa

from millrace.llm import decontaminate


class Held:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


def batches(texts, rows):
    return [pa.RecordBatch.from_pydict({"doc_id": list(range(k, k + len(texts[k : k + rows]))), "text": texts[k : k + rows]}) for k in range(0, len(texts), rows)]


def test_an_automaton_is_built_once_per_pass(monkeypatch):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abcdefgh", k=14))) for i in range(30)]
    texts = [None, ""] + [" ".join(rng.choices("abcdefgh", k=40) + rng.choice(items)[1].split()[: rng.randint(8, 14)]) for _ in range(50)]
    built = []
    make = decontaminate.automaton
    monkeypatch.setattr(decontaminate, "automaton", lambda part, size: built.append(len(part)) or make(part, size))

    def run(blocks, rows):
        scan = decontaminate.Scanner([Held(b) for b in blocks], 10).scan
        return [(n, None if hit is None else hit.tolist(), ids) for _, found in scan(iter(batches(texts, rows)), 1) for n, hit, ids in found]

    whole = run([items], 4)
    assert built == [30] and sum(bool(ids) for _, _, ids in whole) > 20
    built.clear()
    assert run([items[:10], items[10:20], items[20:]], 4) == whole
    assert built == [10, 10, 10]  # all documents fit one pass
    built.clear()
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 2000)
    assert run([items[:10], items[10:]], 4) == whole
    assert 4 <= len(built) < 2 * 13


def test_a_large_benchmark(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=400))) for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=50)) + " " + " ".join(items[i][1].split()[i % 300 : i % 300 + 9 + i % 2]) for i in range(200)]
    blocks = decontaminate.benchmark_blocks(spark.createDataFrame(items, "item_id long, text string"))
    assert len(blocks) > 2
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.report(documents, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} == {i for i in range(200) if i % 2}
    assert all(r["n_hit"] == 10 for r in found if r["contaminated"])
