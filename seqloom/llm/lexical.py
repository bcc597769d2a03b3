"""Ranked lexical search: term-at-a-time over document batches, with a bounded number of accumulators and exact scores."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import materialize

#: A term after lower-casing A-Z: digits, letters and everything beyond ASCII, in UTF-8.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Items are searched in blocks of so many different terms; a block holds one item at least.
BLOCK_TERMS = 200_000
#: Postings of the documents that are scored together.
BATCH_POSTINGS = 1_000_000
LAST = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    # bytes.lower touches A-Z alone
    return TERM.findall(text.lower()) if text else []


def item_blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[list[tuple[Any, Counter]]]:
    """Items as ``(item_id, terms with their counts)`` in lists whose different terms fit into ``most``."""
    block, seen = [], set()
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        counts = Counter(terms_of(row["text"] and bytes(row["text"])))
        if block and len(seen | counts.keys()) > most:
            yield block
            block, seen = [], set()
        block.append((row["item_id"], counts))
        seen |= counts.keys()
    if block:
        yield block


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of each document with a term: its length, and its terms of the vocabulary by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                if found:
                    held = {vocabulary[t]: n for t, n in Counter(found).items() if t in vocabulary}
                    ids.append(doc_id)
                    sizes.append(len(found))
                    terms.append(list(held))
                    tfs.append(list(held.values()))
            arrays = [
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(tfs, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Postings:
    """Documents of a batch by term: rows, what each adds per unit of weight, and the largest of these per term."""

    rows: np.ndarray
    impacts: np.ndarray
    starts: np.ndarray
    largest: np.ndarray

    @classmethod
    def of(cls, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, size: int, n_docs: int, length: int):
        m = 25 + (75 * n * n_docs) // length
        rows = np.repeat(np.arange(len(n)), counts)
        impacts = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[rows])
        order = np.argsort(terms, kind="stable")
        starts = np.searchsorted(terms[order], np.arange(size + 1))
        rows, impacts = rows[order], impacts[order]
        largest = np.zeros(size, np.int64)
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            largest[full] = np.maximum.reduceat(impacts, starts[full])
        return cls(rows, impacts, starts, largest)

    def term(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[t], self.starts[t + 1])
        return self.rows[part], self.impacts[part]


def rank_batch(
    postings: Postings, terms: np.ndarray, weights: np.ndarray, n_rows: int, k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the batch that may be among the ``k`` best, with their exact scores; ``terms`` come rarest first.

    ``floor`` is the k-th best score known from elsewhere. While the terms left may lift a document that has no
    accumulator yet to the k-th partial score, their documents get one. After that only the survivors are updated, and of
    them only those that can still reach it. A score equal to the k-th may win by its doc_id, so it counts as reached.
    """
    bounds = weights * postings.largest[terms]
    rest = np.append(np.cumsum(bounds[::-1])[::-1], 0)
    scores = np.zeros(n_rows, np.int64)
    need, done = floor, 0
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        # the k-th partial score is at most what the terms so far can add up to
        if rest[i] < rest[0] - rest[i] and n_rows >= k:
            need = max(need, int(np.partition(scores, n_rows - k)[n_rows - k]))
        if rest[i] < need:
            break
        rows, impacts = postings.term(t)
        scores[rows] += w * impacts
        done = i + 1
    survivors = np.flatnonzero(scores)
    survivors = survivors[scores[survivors] + rest[done] >= need]
    kept = scores[survivors]
    for t, w in zip(terms[done:], weights[done:], strict=True):
        rows, impacts = postings.term(t)
        if len(rows) and len(survivors):
            at = np.minimum(np.searchsorted(rows, survivors), len(rows) - 1)
            kept += np.where(rows[at] == survivors, w * impacts[at], 0)
    return survivors, kept


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        among = np.flatnonzero(scores >= least)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))[:k]]


def _search(index: DataFrame, block: list, vocabulary: dict, dfs: dict, n_docs: int, length: int, k: int) -> DataFrame:
    weights = np.array([term_weight(n_docs, dfs.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    queries = []
    for counts in (c for _, c in block):
        held = sorted((dfs[i], i, n) for t, n in counts.items() if (i := vocabulary[t]) in dfs)  # rarest first
        terms = np.array([i for _, i, _ in held], np.int64)
        queries.append((terms, weights[terms] * np.array([n for _, _, n in held], np.int64)))
    size = len(vocabulary)

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        lists, values = batch.column(2), batch.column(3)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        a = 0
        while a < batch.num_rows:
            before = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, before + BATCH_POSTINGS, "right")))
            cut = slice(a, b)
            ids = batch.column(0).slice(a, b - a).fill_null(LAST).to_numpy()
            n = batch.column(1).slice(a, b - a).to_numpy()
            counts = np.diff(np.append(before, ends[cut]))
            terms, tfs = (x.slice(a, b - a).flatten().to_numpy() for x in (lists, values))
            yield ids, Postings.of(n, counts, terms, tfs, size, n_docs, length)
            a = b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for batch in batches:
            for ids, postings in parts(batch):
                for q, (terms, weights) in enumerate(queries):
                    scores, docs = best[q]
                    rows, found = rank_batch(postings, terms, weights, len(ids), k, int(scores[-1]) if len(scores) == k else 1)
                    if len(rows):
                        scores, docs = np.append(scores, found), np.append(docs, ids[rows])
                        top = _best(scores, docs, k)
                        best[q] = scores[top], docs[top]
        for q, (scores, docs) in enumerate(best):
            keep = scores > 0
            if keep.any():
                docs = pa.array(docs[keep], mask=docs[keep] == LAST)
                item = pa.array(np.full(int(keep.sum()), q, np.int64))
                yield pa.RecordBatch.from_arrays([item, docs, pa.array(scores[keep])], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item with a score above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text. Every whole text counts for the statistics and is ranked; a null or
    empty text has no term, and an item without a term in any document has no row. Ties go by doc_id, null last. Repeated
    rows of documents rank one by one. Rows of items with one item_id are searched apart, each with ranks from 1.

    Items are the stated query set: they are read in blocks of ``BLOCK_TERMS`` different terms. For each block the texts become
    a narrow index of the block's terms, written to the shared folder; document frequencies are a partial aggregate of it.
    Tasks then score batches of documents and keep ``k`` per item, so only those are shuffled.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    found = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    for block in item_blocks(items):
        vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, c in block for t in c))}
        index = materialize(forward_index(docs, vocabulary), "lexical-index")
        n_docs, length = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one number per term of the block
        dfs = dict(map(tuple, index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
        if not dfs:
            continue
        ranked = _search(index, block, vocabulary, dfs, n_docs, length, k)
        w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = materialize(ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "lexical-ranks")
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item long, item_id {kind.simpleString()}")
        found = found.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return found
