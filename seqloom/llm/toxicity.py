"""Toxic sentences by multiple-instance learning from document labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import labelled_sample, map_texts, slices

#: Bounds of the fit: labelled documents read, and features kept.
TRAIN_DOCS, FEATURES = 12_000, 6_000
#: Documents that must have a feature before it counts, and a document's score from which it is toxic.
LEAST_DOCS, THRESHOLD = 3, 0.5
#: G statistic from which a feature counts; chance alone passes it about once in 3000 features (chi-square of one degree).
LEAST_G = 13.0
SEED = 101
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Weights of words and word starts in a sentence, and a sentence's bias."""

    weights: dict[str, float]
    bias: float


def features(words: set[str]) -> set[str]:
    """Words, and the first four and five letters of words as ``stem*``."""
    return words | {w[:4] + "*" for w in words} | {w[:5] + "*" for w in words if len(w) > 4}


def sentence_features(text: str) -> Iterator[tuple[int, int, set[str]]]:
    for m in SENTENCE.finditer(text):
        yield m.start(), m.end(), features(set(WORD.findall(m[0].lower())))


def _informative(sample: DataFrame, limit: int) -> list[str]:
    """The ``limit`` features that say most about the label (G statistic) of those seen more often with label 1, if it is enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
                for text, label in zip(texts[a:b], labels[a:b], strict=True):
                    seen[1 if label else 0].update(features(set(WORD.findall(text.lower()))))
                names = list(seen[0].keys() | seen[1].keys())
                columns = [pa.array(names), *(pa.array([seen[y][f] for f in names], pa.int64()) for y in (1, 0))]
                yield pa.RecordBatch.from_arrays(columns, names=["feature", "pos", "neg"])

    counts = sample.mapInArrow(count, "feature string, pos long, neg long")
    counts = counts.groupBy("feature").agg(F.sum("pos").alias("a"), F.sum("neg").alias("c"))
    counts = counts.where(F.col("a") >= LEAST_DOCS)
    n = sample.agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).first()
    if not n["pos"] or not n["neg"]:
        return []
    pos, neg = float(n["pos"]), float(n["neg"])

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    both = F.col("a") + F.col("c")
    rest_a, rest_c = F.lit(pos) - F.col("a"), F.lit(neg) - F.col("c")
    share, left = pos / (pos + neg), F.lit(pos + neg) - both
    g = 2 * (
        part(F.col("a"), both * share)
        + part(F.col("c"), both * (1 - share))
        + part(rest_a, left * share)
        + part(rest_c, left * (1 - share))
    )
    best = counts.where((F.col("a") * neg > F.col("c") * pos) & (g >= LEAST_G)).orderBy(g.desc(), "feature").limit(limit)
    return sorted(r["feature"] for r in best.select("feature").collect())


def _instances(sample: DataFrame, known: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Sentences with known features (numbers), their document, and each document's other sentences and label."""
    number = {f: i for i, f in enumerate(known)}

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, plain = [], []
            for text in batch.column(0).to_pylist():
                found, rest = [], 0
                for _, _, fs in sentence_features(text):
                    known_here = sorted(number[f] for f in fs if f in number)
                    if known_here:
                        found.append(known_here)
                    else:
                        rest += 1
                hits.append(found)
                plain.append(rest)
            columns = [pa.array(hits, pa.list_(pa.list_(pa.int32()))), pa.array(plain, pa.int64()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["hits", "plain", "label"])

    rows = sample.mapInArrow(reduce, "hits array<array<int>>, plain long, label int").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["label"], r["plain"], r["hits"]))  # the order of tasks must not show in the weights
    sentences = [np.array(s, dtype=np.int64) for r in rows for s in r["hits"]]
    doc = np.repeat(np.arange(len(rows)), [len(r["hits"]) for r in rows])
    plain = np.array([r["plain"] for r in rows], dtype=np.float64)
    label = np.array([1 if r["label"] else 0 for r in rows], dtype=np.float64)
    return sentences, doc, plain, label


def fit(sample: DataFrame, max_features: int = FEATURES, rounds: int = 400) -> Model:
    """Fit sentence weights on ``sample(text, label)`` so that the noisy-or of a document's sentences meets its label.

    A sentence with features ``x`` is toxic with probability ``sigmoid(w.x + b)``, a document unless all its sentences are
    not. The likelihood of the labels with a small penalty is climbed by Adam on the driver. What it gets is bounded by the
    sample and the number of features: the known features of each sentence, not the texts. Without both labels
    the model has no weights and every score is 0.
    """
    known = _informative(sample, max_features)
    if not known:
        return Model({}, -50.0)
    sentences, doc, plain, label = _instances(sample, known)
    flat = np.concatenate(sentences) if sentences else np.zeros(0, dtype=np.int64)
    of = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    n = len(label)
    w = np.zeros(len(known) + 1)
    w[-1] = -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = w[-1] + np.bincount(of, w[flat], minlength=len(sentences))
        p = 1 / (1 + np.exp(-z))
        base = 1 / (1 + np.exp(-w[-1]))
        total = np.bincount(doc, np.logaddexp(0, z), minlength=n) + plain * np.logaddexp(0, w[-1])
        pull = np.where(label > 0, 1 / np.expm1(np.clip(total, 1e-6, 500)), -1.0)
        on_sentence = pull[doc] * p
        grad = np.append(np.bincount(flat, on_sentence[of], minlength=len(known)), 0.0)
        grad[-1] = on_sentence.sum() + (pull * plain).sum() * base
        grad = grad / n - 1e-5 * np.append(w[:-1], 0.0)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    kept = {f: float(v) for f, v in zip(known, w, strict=False) if abs(v) > 1e-3}
    return Model(kept, float(w[-1]))


SCORED = "score double, predicted int, n_sentences int, toxic_spans array<struct<start:int,end:int,score:double>>"


def score_text(text: str, model: Model, threshold: float = THRESHOLD) -> tuple[float, int, list[dict]]:
    """Document score, number of sentences and the sentences that are toxic by themselves, as code-point spans."""
    weights, bias = model.weights, model.bias
    known = weights.get
    odds, n, spans = 0.0, 0, []
    plain = 0
    for m in SENTENCE.finditer(text):
        n += 1
        z = 0.0
        starts = set()
        for w in set(WORD.findall(m[0].lower())):
            z += known(w, 0.0)
            starts.add(w[:4] + "*")
            if len(w) > 4:
                starts.add(w[:5] + "*")
        for s in starts:
            z += known(s, 0.0)
        if not z:
            plain += 1
            continue
        z += bias
        odds += max(z, 0.0) + float(np.log1p(np.exp(-abs(z))))
        if z >= 0 and 1 / (1 + np.exp(-z)) >= threshold:
            spans.append({"start": m.start(), "end": m.end(), "score": float(1 / (1 + np.exp(-z)))})
    odds += plain * float(np.logaddexp(0, bias))
    return float(-np.expm1(-odds)), n, spans


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its text and with score, ``predicted``, number of sentences and the toxic sentences' spans.

    Every whole text is read. Null and empty texts have no sentence and score 0. Rows are scored one by one, so
    repeated rows get equal scores; columns other than ``text`` pass through and are never used.
    """

    def run(texts: list[str]) -> dict[str, list]:
        found = [score_text(t, model, threshold) for t in texts]
        scores = [s for s, _, _ in found]
        return {
            "score": scores,
            "predicted": [int(s >= threshold) for s in scores],
            "n_sentences": [n for _, n, _ in found],
            "toxic_spans": [spans for _, _, spans in found],
        }

    return map_texts(docs, run, SCORED)


def train(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = TRAIN_DOCS) -> Model:
    """A model from at most about ``limit`` documents with a ``toxic`` label for which ``usable`` holds."""
    return fit(labelled_sample(docs, labels, "toxic", usable, limit, SEED))
