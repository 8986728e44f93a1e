"""License notices, ranked search and phrase collocations against brute force, and on awkward rows."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import collocations, notices, ranking
from millrace.llm.decontaminate import normalised

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("score", "rank", "phrase", "a", "n", "k", "size", "part", "bits", "terms", "counts", "labels", "spans", "term", "item_id", "head", "cut")


def documents(spark, rows):
    """Rows of id, text and language, with columns that clash with names used inside the operators."""
    df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCS)
    return df.withColumns({name: F.lit("x") for name in CLASHING})


AWKWARD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t .;", None),
    (None, "under the MIT License", None),
    (None, None, None),
    (5, "é中\U0001f600  x, x", "en"),
    (6, "same line", "fr"),
    (6, "same line", "fr"),
    (7, "other text, same id", "fr"),
    (7, "word " * 60_000, "de"),
    (8, "no-words-" * 50_000, "de"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, AWKWARD)


# Licenses


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute_notices(text):
    """(notice, first word, words, edits) by edit distance of every run of words."""
    words = [w.decode("latin-1") for w in normalised((text or "").encode()).split()]
    out = []
    for number, notice in enumerate(notices.NOTICES):
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + len(notice.text.split()) + notice.edits) + 1):
                run = " ".join(words[a:b])
                if abs(len(run) - len(notice.text)) <= notice.edits and notice.core in words[a:b]:
                    if (edits := distance(run, notice.text)) <= notice.edits:
                        out.append((number, a, b - a, edits))
    return sorted(out)


def scrambled(rng):
    parts = []
    for _ in range(rng.randint(1, 3)):
        text = list(rng.choice(notices.NOTICES).text)
        for _ in range(rng.randint(0, 6)):
            at, kind = rng.randrange(len(text)), rng.random()
            if kind < 0.4:
                text[at] = rng.choice("abcé t")
            elif kind < 0.7:
                text.insert(at, rng.choice("abc e"))
            elif len(text) > 1:
                del text[at]
        parts += ["".join(text), rng.choice(["the mit", "under", "", "x y", "license version 2"])]
    return rng.choice([" ", "\n", "- "]).join(parts)


def test_seeds_lose_no_notice():
    rng = random.Random(3)
    scanner = notices.Scanner(notices.NOTICES)
    texts = [scrambled(rng) for _ in range(400)]
    found = [scanner.scan(t.encode())[1] for t in texts]
    assert found == [brute_notices(t) for t in texts]
    assert sum(map(len, found)) > 300


def test_license_spans_and_labels(spark):
    df = documents(
        spark,
        [
            (1, "Ü: released under the MIT License.", "en"),
            (2, "Licensed undr the Apache Licence, Version 2", "en"),
            (3, "GNU General Public License, version 3; under the MIT license. Under the mit LICENSE", "en"),
            (4, "under the MPL license, GNU General Public License version 2", "en"),
            (5, "no notice here; cc by nd, cc by ncx", "en"),
        ],
    )
    found = {r["doc_id"]: r for r in notices.license_scan(df).collect()}
    one = found[1]
    assert (one["n_base"], one["first_word"], one["last_word"], one["base_labels"], one["score"]) == (1, 2, 2, ["mit"], 1.0)
    assert [(s["label"], "Ü: released under the MIT License."[s["start"] : s["end"]], s["edits"]) for s in one["spans"]] == [
        ("mit", "under the MIT License", 0)
    ]
    assert (found[2]["labels"], found[2]["base_labels"], found[2]["first_word"]) == (["apache-2"], [], None)
    assert found[2]["score"] == round(1 - 1 / 24, 6)
    assert (found[3]["n_base"], found[3]["first_word"], found[3]["last_word"]) == (2, 6, 10)
    assert found[3]["labels"] == ["gpl-3", "mit"]
    assert found[4]["labels"] == ["gpl-2"]
    assert (found[5]["labels"], found[5]["score"]) == ([], 0.0)


def test_license_scan_of_a_text_full_of_seeds():
    begin = time.time()
    n, runs = notices.Scanner(notices.NOTICES).scan(b"license version 2 under the mit license " * 20_000)
    assert n == 140_000 and sum(not edits for *_, edits in runs) == 20_000 and time.time() - begin < 60


def test_license_rows(awkward):
    found = notices.report(awkward).collect()
    assert len(found) == len(AWKWARD)
    assert [r["labels"] for r in found if r["labels"]] == ["mit"]
    assert notices.report(awkward.limit(0)).collect() == []


# Ranked search


def terms(text):
    return normalised((text or "").encode()).split()


def brute_ranks(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t, _ in docs]
    n_docs = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    holding = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        if item is None or text is None:
            continue
        scored = []
        for doc, counts in held:
            norm = 10 + 90 * sum(counts.values()) * n_docs // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * norm))
                for t in set(terms(text))
                if t in counts
            )
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def search_case(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(120)] + ["É", "Über", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))), "en") for i in range(600)]
    rows += [(1000 + i, "copy of one text w1 w2", "en") for i in range(150)]  # ties, and equal vectors
    rows += [(2000 + i, " ".join(f"w{j}" for j in range(i)), "en") for i in range(120)]  # a long chain of prefixes
    rows += [(3, "w1, W2; repeated id", "en"), (None, "w1 w5 w80", "en"), (4000, None, "en"), (4001, "w7 " * 3000, "en")]
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(40)]
    items += [(900, "copy of w1"), (901, "unknown words only"), (902, ""), (903, None), (None, "w1"), (904, "W1 w1; É"), (904, "w2")]
    expected_items = [x for x in items if x[0] != 904] + [(904, "W1 w1; É w2")]
    return documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), brute_ranks(rows, expected_items, 10)


@pytest.mark.parametrize("sizes", [{}, {"shard_entries": 300, "leaf": 4}, {"block_bytes": 400, "leaf": 1}])
def test_ranks_equal_brute_force(search_case, sizes):
    docs, items, expected = search_case
    found = ranking.ranked(docs.repartition(3), items, **sizes).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found) == expected


def test_bounds_hold_and_leave_leaves_out():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 12, 3000)
    # Two kinds of documents that share no term.
    terms_of = [np.sort(rng.choice(50, n, replace=False) + 50 * (d % 2)) for d, n in enumerate(sizes)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    counts = rng.integers(1, 6, first[-1])
    tree = ranking.Tree(np.arange(3000), rng.integers(10, 300, 3000), first, np.concatenate(terms_of).astype(np.int32), counts, leaf=16)
    weights = rng.integers(1, 9000, 100)
    for item in (np.arange(3), np.array([60, 70, 99]), np.arange(100)):
        bound = tree.bounds(weights, item, np.array([0]))[:, 0]
        weight = np.zeros(100, np.int64)
        weight[item] = weights[item]
        for n, (low, high, _) in enumerate(tree.ranges):
            below = max(int(tree.leaf_scores(m, weight).max()) for m, (a, b, _) in enumerate(tree.ranges) if not tree.children[m] and low <= a and b <= high)
            assert bound[n] >= below
        read = tree.search(bound.tolist(), weight, 10, [])
        assert read < sum(not c for c in tree.children)
    depth = {0: 0}
    for n, children in enumerate(tree.children):
        depth.update({c: depth[n] + 1 for c in children})
    assert max(depth.values()) < 40


def test_search_rows(spark, awkward):
    items = spark.createDataFrame([(1, "word under"), (2, None)], "item_id long, text string")
    found = ranking.ranked(awkward, items).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [(1, 1, 7)]
    assert ranking.ranked(awkward.limit(0), items).collect() == []
    assert ranking.ranked(awkward, items.limit(0)).collect() == []
    assert ranking.ranked(awkward.where("text IS NULL"), items).collect() == []


# Collocations


def brute_collocations(rows, threshold, longest=5, most=2000):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        frequent = {p: c for p, c in own.items() if len(p) > 1 and c >= threshold}
        kept = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in frequent.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, r, totals[lang], -s) for rank, (s, a, p, left, r) in enumerate(sorted(kept)[:most], 1)]
    return sorted(out)


def found_collocations(df, **options):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in collocations.collocations(df, **options).collect())


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(7)
    vocabulary = ["der", "Die", "x", "été", "中", "a-b", "the", "of"] + [f"v{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(500):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        words = [w + rng.choice(["", "", "", "", ",", ".", "\n", "\t", "  ", "!?"]) for w in words]
        if i % 9 == 0:
            words.insert(rng.randint(0, len(words)), "One fixed phrase of six words")
        rows.append((i, " ".join(words), [None, "en", "fr"][i % 3]))
    return rows + [(600, None, "en"), (601, "x " * 3000, "de"), (602, "", None), (1, rows[1][1], "en")]


@pytest.mark.parametrize(("flush", "most"), [(collocations.FLUSH, 2000), (500, 15)])
def test_collocations_equal_brute_force(spark, phrase_rows, flush, most):
    found = found_collocations(documents(spark, phrase_rows).repartition(3), threshold=12, most=most, flush=flush)
    assert found == brute_collocations(phrase_rows, 12, most=most)
    assert len({lang for lang, *_ in found}) == 4 and len(found) > 30


def test_summaries_lose_no_frequent_value():
    rng = np.random.default_rng(2)
    frequent = rng.choice(1 << 32, 50, replace=False).astype(np.uint32)
    stream = np.concatenate([np.repeat(frequent, 100), rng.integers(0, 1 << 32, 200_000).astype(np.uint32)])
    rng.shuffle(stream)
    summary = collocations.Summary(len(stream) // 100 + 1, buffer=3000)
    for part in np.array_split(stream, 40):
        summary.add(*np.unique(part, return_counts=True))
    left = summary.survivors(100)
    assert set(frequent.tolist()) <= set(left.tolist())
    # Decrements happened, and the summary stayed small.
    assert 0 < summary.lost < 100 and len(summary.values) <= len(stream) // 100 + 1
    assert len(left) < 2500


def test_equal_bits_change_nothing(spark, phrase_rows):
    """A map so small that most phrases share a bit."""
    found = found_collocations(documents(spark, phrase_rows), threshold=12, bits_power=10)
    assert found == brute_collocations(phrase_rows, 12)


def test_collocation_rows(awkward):
    assert found_collocations(awkward) == brute_collocations(AWKWARD, 100)
    assert found_collocations(awkward.limit(0)) == []


def test_large_counts_stay_exact(spark):
    rows = [(i, "a b " * 20_000, "en") for i in range(5)]
    assert found_collocations(documents(spark, rows)) == brute_collocations(rows, 100)
