"""Toxicity, quality and language: held-out accuracy, learned structure and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.llm import language, quality, queries, toxicity
from seqloom.llm.common import held_out, unit_draw

INSULTS, PLAIN = ["moron", "scum", "trash"], ["river", "stone", "cloud", "green", "paper", "light"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        sentences = [" ".join(rng.choice(PLAIN, 6)) + "." for _ in range(int(rng.integers(1, 9)))]
        toxic = i % 4 == 0
        if toxic:
            sentences[int(rng.integers(len(sentences)))] = f"you {rng.choice(INSULTS)} there."
        rows.append((i, " ".join(sentences), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_sentences_are_found_from_document_labels(labelled):
    model = toxicity.train(labelled.select("doc_id", "text"), labelled.select("doc_id", "toxic"), F.lit(True))
    rows = toxicity.score(labelled, model).join(labelled.select("doc_id", "text"), "doc_id").collect()
    assert all(r.predicted == r.toxic for r in rows)
    for r in rows:
        found = [r.text[s.start : s.end] for s in r.toxic_spans]
        assert len(found) == r.toxic
        assert all(any(w in f for w in INSULTS) for f in found)


def test_noisy_or_of_the_sentences(labelled):
    model = toxicity.Model({"moron": 4.0, "rive*": 0.5}, -3.0)
    score, n, _ = toxicity.score_text("river bank. moron. clean one.", model)
    p = [1 / (1 + np.exp(-z)) for z in (-2.5, 1.0, -3.0)]
    assert n == 3
    assert score == pytest.approx(1 - np.prod([1 - x for x in p]))
    assert toxicity.score_text("", model)[0] == 0


def test_toxicity_without_labels_or_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels, F.lit(True))
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(r.score < 1e-6 for r in rows)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(awkward, model).columns.count("score") == 1


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(3)
    sizes = np.array([3, 0, 1, 4])
    u, t = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    marginal, pairs, log_z = quality.forward_backward(u, t, sizes)
    at, both = 0, np.zeros((2, 2))
    for size, z in zip(sizes, log_z, strict=True):
        total, on = 0.0, np.zeros((size, 2))
        for code in range(2**size):
            y = [(code >> k) & 1 for k in range(size)]
            p = np.exp(sum(u[at + k, v] for k, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += p
            for k, v in enumerate(y):
                on[k, v] += p
        if size:
            assert z == pytest.approx(np.log(total))
            assert marginal[at : at + size] == pytest.approx(on / total)
        at += size
    assert pairs.sum() == pytest.approx(2 + 3)


def test_quality_held_out(spark, sf):
    scored = queries.op2_line_quality(spark, sf)
    rows = scored.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_quality_on_awkward_rows(spark, awkward, nothing):
    labels = awkward.select("doc_id", F.when(F.col("doc_id") < 6, 1).otherwise(0).alias("quality"))
    model = quality.train(awkward, labels, F.lit(True))
    rows = quality.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert quality.score(nothing, model).count() == 0
    assert quality.fit(nothing.select("text", "label")).slope == 0


def test_language_held_out(spark, sf):
    found = queries.op10_language(spark, sf)
    rows = found.where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95


def test_language_on_awkward_rows(awkward, nothing):
    model = language.fit(awkward, F.lit(True))
    rows = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == rows[5].lang_pred == "und"
    assert rows[2].score == 0 and rows[1].lang_pred == "en"
    none = language.fit(nothing, F.lit(True))
    assert {r.lang_pred for r in language.identify(awkward, none).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0


def test_profile_is_the_sum_of_bound_letters():
    signs = np.random.default_rng(language.SEED).choice(
        np.array([-1, 1], dtype=np.int8), (language.LETTERS, language.DIMENSIONS)
    )
    slots = [0, 1, 2, 0, 3, 0]  # gap a b gap c gap
    total = sum(
        np.roll(signs[a], 2).astype(float) * np.roll(signs[b], 1) * signs[c]
        for a, b, c in zip(slots, slots[1:], slots[2:], strict=False)
    )
    assert language.profile("Ab .. c") == pytest.approx(total / np.linalg.norm(total))
    assert language.profile("12 .") is None


def test_folds_and_draws(spark):
    rows = spark.range(200).select("id", held_out("id", 5, 0).alias("h"), unit_draw(F.lit(1), F.col("id")).alias("u")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.u < 1 for r in rows)


def test_toxicity_query_on_held_out_rows(spark):
    """The registered query: its columns, its folds, and labels that it has not learnt from."""
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.op1_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(found) == docs and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    judged = [(labels[i], r.predicted) for i, r in found.items() if r.held_out and labels.get(i) is not None]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
