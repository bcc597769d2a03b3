"""Language of a text from hyperdimensional letter profiles."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import map_texts, slices, unit_draw

DIMENSIONS, LETTERS, SEED = 1024, 40, 7
#: Bound of the fit: documents per language, in expectation.
TRAIN_DOCS = 4000
UNKNOWN = "und"
#: Partial sums are whole numbers of this unit, so that their order does not matter.
UNIT = 1e-6


@dataclass(frozen=True)
class Model:
    """One prototype vector of length 1 for each learned language."""

    languages: list[str]
    prototypes: np.ndarray


@functools.cache
def _letter_slots() -> np.ndarray:
    """Slot of each code point below 65536: 0 no letter, 1 to 26 for a to z, later ones shared by other letters."""
    slots = np.zeros(65536, dtype=np.uint8)
    for cp in range(65536):
        slots[cp] = _slot(chr(cp))
    return slots


def _slot(char: str) -> int:
    if not char.isalpha():
        return 0
    low = ord(char.lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + low % (LETTERS - 27)


@functools.cache
def _trigram_vectors() -> np.ndarray:
    """Vector of each three-letter run: the product of its letters' random signs, shifted by two, one and no places."""
    signs = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), (LETTERS, DIMENSIONS))
    first, second = np.roll(signs, 2, axis=1), np.roll(signs, 1, axis=1)
    table = first[:, None, None, :] * second[None, :, None, :] * signs[None, None, :, :]
    return table.reshape(LETTERS**3, DIMENSIONS)


def profile(text: str) -> np.ndarray | None:
    """The text's vector, the sum over all its three-letter runs, scaled to length 1; None without a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    slots = _letter_slots()[np.minimum(points, 65535)]
    for at in np.flatnonzero(points > 65535):
        slots[at] = _slot(chr(int(points[at])))
    if not slots.any():
        return None
    slots = np.concatenate(([0], slots, [0])).astype(np.int64)
    slots = slots[np.append(True, (slots[1:] != 0) | (slots[:-1] != 0))]  # one gap between words
    runs = (slots[:-2] * LETTERS + slots[1:-1]) * LETTERS + slots[2:]
    counts = np.bincount(runs, minlength=LETTERS**3)
    present = np.flatnonzero(counts)
    total = np.zeros(DIMENSIONS, dtype=np.float32)
    for at in range(0, len(present), 4096):
        some = present[at : at + 4096]
        total += counts[some].astype(np.float32) @ _trigram_vectors()[some].astype(np.float32)
    total = total.astype(np.float64)
    length = float(np.sqrt(total @ total))
    return total / length if length else None


def fit(docs: DataFrame, usable: Column, limit: int = TRAIN_DOCS) -> Model:
    """Prototypes from ``docs(doc_id, text, lang)`` where ``usable`` holds and ``lang`` is known.

    The documents of a language are counted, and a seeded hash of doc_id keeps about ``limit`` of them; their profiles are
    summed in the tasks that read them and then per language and dimension. The counts are broadcast, and what reaches
    the driver is one vector per language: both are as large as the model itself.
    """
    named = docs.select("doc_id", "text", "lang").where(usable & F.col("lang").isNotNull())
    counts = named.groupBy("lang").count().select(F.col("lang").alias("of"), (F.lit(float(limit)) / F.col("count")).alias("share"))
    drawn = named.join(F.broadcast(counts), F.col("lang") == F.col("of")).where(
        unit_draw(F.lit(SEED), F.col("doc_id")) < F.col("share")
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, np.ndarray] = {}
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for text, lang in zip(texts, langs, strict=True):
                vector = profile(text or "")
                if vector is not None:
                    total[lang] = total.get(lang, 0) + np.rint(vector / UNIT).astype(np.int64)
            if total:
                columns = [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "total"])

    parts = drawn.select("text", "lang").mapInArrow(sums, "lang string, total array<long>")
    found = parts.select("lang", F.posexplode("total").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    vectors: dict[str, np.ndarray] = {}
    for r in found.collect():
        vectors.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["v"]
    languages = sorted(lang for lang, v in vectors.items() if v.any())
    prototypes = [vectors[lang] / np.linalg.norm(vectors[lang]) for lang in languages]
    return Model(languages, np.array(prototypes).reshape(len(languages), DIMENSIONS))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without its text and with ``lang_pred`` and ``score``.

    The score is the cosine with the nearest prototype (negative ones count as 0); ties go to the first language by code
    point. A null text, or one without a letter, is ``und`` with score 0, and so is every text if no language was learned.
    Each row stands alone; columns other than ``text`` pass through unused.
    """

    def run(texts: list[str]) -> dict[str, list]:
        langs, scores = [], []
        for a, b in slices(texts):
            for text in texts[a:b]:
                vector = profile(text) if model.languages else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = model.prototypes @ vector
                best = int(cosine.argmax())
                langs.append(model.languages[best])
                scores.append(float(min(1.0, max(0.0, cosine[best]))))
        return {"lang_pred": langs, "score": scores}

    return map_texts(docs, run, "lang_pred string, score double")
