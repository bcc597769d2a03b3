"""Ranked search against a plain scorer."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from seqloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + (75 * n * n_docs) // length)))
                for t in terms(text)
                if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, k=10):
    return sorted((tuple(r) for r in lexical.search(docs, items, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_whole_table(spark, sf, documents):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = expected([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(documents, items) == want


@pytest.mark.parametrize("frame", ["awkward", "nothing"])
def test_odd_rows(spark, frame, request):
    docs = request.getfixturevalue(frame)
    rows = [(1, "THE cat; the idiot"), (2, None), (3, "word3 word5 token7 nowhere"), (None, "straße İstanbul été"), (3, "x the"), (5, "")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    assert found(docs, items) == expected([(r.doc_id, r.text) for r in docs.collect()], rows)


def test_many_ties_in_small_batches_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BATCH_POSTINGS", 40)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["rare", "Rarer"]
    docs = [(i, " ".join(rng.choices(words, weights=[30 / (j + 1) for j in range(32)], k=rng.choice([1, 3, 8, 8, 8])))) for i in range(400)]
    docs += [(i % 50, "w1 w2 w3") for i in range(300)]  # equal scores and repeated ids
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    blocks = lexical.item_blocks
    monkeypatch.setattr(lexical, "item_blocks", lambda x: blocks(x, 20))
    assert found(frame, spark.createDataFrame(items, "item_id long, text string"), 7) == expected(docs, items, 7)


def test_accumulators_stop_and_survivors_are_exact():
    rng = np.random.default_rng(1)
    n, size, k = 2000, 40, 10
    held = defaultdict(dict)
    for t in range(size):
        for d in rng.choice(n, size=5 if t < 4 else 60 * (t + 1) // 2, replace=False):
            held[int(d)][t] = int(rng.integers(1, 4))
    counts = np.array([len(held[d]) for d in range(n)])
    terms = np.array([t for d in range(n) for t in held[d]])
    tfs = np.array([f for d in range(n) for f in held[d].values()])
    lengths = counts * 3 + 1
    p = lexical.Postings.of(lengths, counts, terms, tfs, size, n, int(lengths.sum()))
    weights = np.array([int(1.5 ** (size - t)) for t in range(size)])
    touched = []
    term = p.term
    p.term = lambda t: touched.append(t) or term(t)
    rows, scores = lexical.rank_batch(p, np.arange(size), weights, n, k, 1)
    whole = np.zeros(n, np.int64)
    for t in range(size):
        r, i = term(t)
        whole[r] += weights[t] * i
    best = np.sort(whole)[-k:]
    assert sorted(scores)[-k:] == list(best) and (whole[rows] == scores).all()
    assert len(rows) < n / 4 and touched == list(range(size))
