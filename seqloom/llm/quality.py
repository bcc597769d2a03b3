"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from seqloom.llm.common import labelled_sample, map_texts, slices

#: Bounds of the fit: labelled documents read, and the most lines of a document that is learned from.
TRAIN_DOCS, TRAIN_LINES = 6000, 2000
THRESHOLD = 0.7
SEED = 202
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
PLAIN = b" \t.,;:'\"-()?!"
MARKS = bytes(c for c in range(33, 127) if c not in UPPER + LOWER + DIGITS + PLAIN)


@dataclass(frozen=True)
class Model:
    """Line weights, label-to-label weights (bad, good), and the line from good share to document score."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    shift: float


def _share(data: bytes, chars: bytes) -> float:
    return 1 - len(data.translate(None, chars)) / len(data) if data else 0.0


def line_features(lines: list[str]) -> np.ndarray:
    """Shares of character kinds, word lengths, repetition and shape of each line, by itself."""
    rows, seen = [], set()
    for line in lines:
        data = line.encode("utf-8", "replace")
        words = line.split()
        n = len(words)
        repeats = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n if n else 0.0
        upper, marks = _share(data, UPPER), _share(data, MARKS)
        last = line.rstrip()[-1:]
        mean = len(line) / n if n else 0.0
        rows.append(
            (
                upper,
                float(upper > 0.4),
                marks,
                float(marks > 0.05),
                _share(data, DIGITS),
                float(n == 0),
                min(1.0, math.log1p(n) / 8),
                float(0 < n < 4),
                min(2.0, mean / 10),
                float(mean > 14),
                repeats,
                float(repeats > 0.3),
                len(set(words)) / n if n else 1.0,
                float(last in ".!?"),
                line.count("|") / n if n else 0.0,
                line.count("!!") / n if n else 0.0,
                float(line in seen),
            )
        )
        seen.add(line)
    return np.array(rows, dtype=np.float32).reshape(len(rows), OWN)


OWN = 17


def with_neighbours(own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of lines that lie document by document: own, of the line before and after, border marks and a constant."""
    n = len(own)
    start = np.cumsum(sizes) - sizes
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    full = sizes > 0
    first[start[full]] = True
    last[(start + sizes - 1)[full]] = True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    borders = np.stack([first, last, np.ones(n)], axis=1)
    return np.concatenate([own, before, after, borders], axis=1, dtype=np.float64)


def forward_backward(u: np.ndarray, t: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals (line, label), expected label pairs (2, 2) in all and log partition of each document.

    ``u`` holds the label scores of all lines, document by document. Documents are worked through side by side, the
    longest first, so a step handles one line of each that still has one.
    """
    order = np.argsort(-sizes, kind="stable")
    length = sizes[order]
    start = (np.cumsum(sizes) - sizes)[order]
    alpha, beta = np.zeros_like(u), np.zeros_like(u)
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
    for k in range(longest):
        at = start[: active[k]] + k
        if k:
            a = alpha[at - 1]
            alpha[at] = np.logaddexp(a[:, :1] + t[0], a[:, 1:] + t[1])
        alpha[at] += u[at]
    pairs = np.zeros((2, 2))
    log_z = np.zeros(len(sizes))
    full = length > 0
    end = (start + length - 1)[full]
    log_z[order[full]] = np.logaddexp(alpha[end, 0], alpha[end, 1])
    z = log_z[order]
    for k in range(longest - 2, -1, -1):
        at = start[: active[k + 1]] + k
        after = u[at + 1] + beta[at + 1]
        step = t[None] + after[:, None, :]
        beta[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
        pairs += np.exp(alpha[at][:, :, None] + step - z[: active[k + 1], None, None]).sum(axis=0)
    marginal = np.exp(alpha + beta - np.repeat(log_z, sizes)[:, None])
    return marginal, pairs, log_z


def _climb(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, w: np.ndarray, t: np.ndarray, rounds: int) -> None:
    """Raise the likelihood of the line labels ``y`` (1 good) by Adam, in place."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inner = doc[1:] == doc[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner], y[1:][inner]), 1)
    theta = np.concatenate([w, t.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        score = x @ theta[:-4]
        u = np.stack([np.zeros_like(score), score], axis=1)
        marginal, pairs, _ = forward_backward(u, theta[-4:].reshape(2, 2), sizes)
        grad = np.concatenate([x.T @ (y - marginal[:, 1]), (seen - pairs).ravel()]) / len(x) - 1e-4 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w[:], t[:] = theta[:-4], theta[-4:].reshape(2, 2)


def good_share(p_good: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities of being good, weighted by their lengths; 0 without lines."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    total = np.bincount(doc, weight, minlength=len(sizes))
    return np.bincount(doc, weight * p_good, minlength=len(sizes)) / np.maximum(total, 1)


def _lines(text: str) -> list[str]:
    return text.split("\n") if text else []


def _marginals(x: np.ndarray, w: np.ndarray, t: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    score = x @ w
    return forward_backward(np.stack([np.zeros_like(score), score], axis=1), t, sizes)[0][:, 1]


def fit(sample: DataFrame, rounds: int = 120) -> Model:
    """Fit the field on ``sample(text, label)``.

    Only documents are labelled, so every line starts with its document's label. After a first fit, lines of bad documents
    that look good are relabelled (a bad document keeps its worst line as bad) and the fit goes on. A logistic line from the
    length-weighted share of good lines to the label makes the score. The driver gets the line features of
    the bounded sample. Without both labels every score is the mean label (0 without labels).
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [_lines(t) for t in batch.column(0).to_pylist()]
            kept = [i for i, x in enumerate(lines) if len(x) <= TRAIN_LINES]
            rows = [line_features(lines[i]).ravel().tolist() for i in kept]
            lengths = [[len(s) for s in lines[i]] for i in kept]
            columns = [pa.array(rows, pa.list_(pa.float32())), pa.array(lengths, pa.list_(pa.int32()))]
            labels = batch.column(1).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, labels], names=["x", "lengths", "label"])

    got = sample.mapInArrow(extract, "x array<float>, lengths array<int>, label int").toArrow()
    label = np.array([1 if v else 0 for v in got["label"].to_pylist()], dtype=np.int64)
    width = 3 * OWN + 3
    if not len(label) or label.min() == label.max():
        mean = float(label.mean()) if len(label) else 0.0
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, 50.0 if mean > 0.5 else -50.0)
    docs = sorted(
        zip(got["x"].to_pylist(), got["lengths"].to_pylist(), label.tolist(), strict=True), key=lambda d: (d[1], d[2], d[0])
    )  # the order of tasks must not show in the weights
    sizes = np.array([len(d[1]) for d in docs])
    own = np.concatenate([np.array(d[0], dtype=np.float32) for d in docs]).reshape(-1, OWN)
    weight = np.concatenate([np.array(d[1], dtype=np.float64) for d in docs])
    label = np.array([d[2] for d in docs])
    x = with_neighbours(own, sizes)
    w, t = np.zeros(width), np.zeros((2, 2))
    y = np.repeat(label, sizes)
    _climb(x, y, sizes, w, t, rounds)
    p = _marginals(x, w, t, sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    worst = np.full(len(sizes), np.inf)
    np.minimum.at(worst, doc, p)
    y = np.where((y == 0) & (p > 0.5) & (p > worst[doc]), 1, y)
    _climb(x, y, sizes, w, t, rounds // 2)
    share = good_share(_marginals(x, w, t, sizes), weight, sizes)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps with a small penalty on the slope
        q = 1 / (1 + np.exp(-np.clip(slope * share + shift, -30, 30)))
        v = np.maximum(q * (1 - q), 1e-9)
        g = np.array([((label - q) * share).sum() - 1e-2 * slope, (label - q).sum()])
        h = np.array([[(v * share**2).sum() + 1e-2, (v * share).sum()], [(v * share).sum(), v.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, shift = slope + move[0], shift + move[1]
        if np.abs(move).max() < 1e-9:
            break
    return Model(w, t, float(slope), float(shift))


SCORED = "score double, predicted int, n_lines int, bad_lines array<int>"


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without its text and with score, ``predicted``, the number of lines and the numbers of bad lines.

    Every line of every whole text is labelled. Null and empty texts have no line and a good share of 0. Rows are scored
    one by one; columns other than ``text`` pass through and are never used.
    """

    def run(texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"score": [], "predicted": [], "n_lines": [], "bad_lines": []}
        for a, b in slices(texts):
            lines = [_lines(t) for t in texts[a:b]]
            sizes = np.array([len(x) for x in lines])
            own = np.concatenate([line_features(x) for x in lines]) if sizes.sum() else np.zeros((0, OWN), np.float32)
            weight = np.array([len(s) for x in lines for s in x], dtype=np.float64)
            p = _marginals(with_neighbours(own, sizes), model.weights, model.transitions, sizes)
            share = good_share(p, weight, sizes)
            scores = 1 / (1 + np.exp(-np.clip(model.slope * share + model.shift, -30, 30)))
            ends = np.cumsum(sizes)
            out["score"] += scores.tolist()
            out["predicted"] += (scores >= threshold).astype(int).tolist()
            out["n_lines"] += sizes.tolist()
            out["bad_lines"] += [np.flatnonzero(p[e - n : e] < 0.5).tolist() for e, n in zip(ends, sizes, strict=True)]
        return out

    return map_texts(docs, run, SCORED)


def train(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = TRAIN_DOCS) -> Model:
    """A model from at most about ``limit`` documents with a ``quality`` label for which ``usable`` holds."""
    return fit(labelled_sample(docs, labels, "quality", usable, limit, SEED))
