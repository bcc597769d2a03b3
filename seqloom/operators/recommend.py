"""Vector scoring and top-K recommendation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from seqloom.functions.encode import genre_text, time_slot_label, title_or_default
from seqloom.operators.skew import first_rows_per_key

#: Memory of one block of item vectors and of one slice of user vectors in a task, as float32.
BLOCK_BYTES = 128 << 20
#: Users and items whose products are taken at once.
_USERS_AT_ONCE, _ITEMS_AT_ONCE = 512, 8_192
#: Items of the first part, those with the largest norms.
_FIRST_ITEMS = 256
SCORE_DIGITS = 6


def _mean_vector(vector: str, weight: Column) -> Column:
    """Weighted mean of arrays as a mergeable aggregate."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return vector_to_array(Summarizer.mean(dense, weight))


def interaction_counts(history: DataFrame) -> DataFrame:
    """One row per (user, item) with the number of interactions.

    Everything below works on these pairs, so neither a hot user nor a hot item arrives with all its rows.
    """
    return history.groupBy("user_id", "item").agg(F.count(F.lit(1)).alias("weight"))


def user_vectors(pairs: DataFrame, item_vectors: DataFrame) -> DataFrame:
    """Mean of the vectors of a user's items, repeated items counted as often as they occur."""
    joined = pairs.join(item_vectors.select("item", "vec").where("vec IS NOT NULL"), "item")
    return joined.groupBy("user_id").agg(_mean_vector("vec", F.col("weight").cast("double")).alias("vec"))


def unseen_candidates(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidate (user, item) rows whose item is not in the user's history."""
    seen = history.select("user_id", "item").distinct()
    return candidates.join(seen, ["user_id", "item"], "left_anti")


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Vectors of ``size`` as rows; another length is an error, since it would shift all vectors behind it."""
    if set(pc.list_value_length(lists).unique().to_pylist()) - {size}:
        raise ValueError("vectors must have the same length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), size)


class Lookup:
    """Vectors by id: the places of the rows of each id. A null id is found by nobody."""

    def __init__(self, ids: pa.Array, vectors: pa.Array):
        coded = ids.dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        self.ids, self.vectors, self.values = ids, vectors, coded.dictionary
        self.order = np.argsort(codes, kind="stable")
        self.begin = np.searchsorted(codes[self.order], np.arange(len(self.values) + 2))

    def find(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As a left join: the number of a key and the place of a row of its id, -1 for a key without any."""
        code = pc.index_in(keys, value_set=self.values, skip_nulls=True)
        at = code.fill_null(0).to_numpy(zero_copy_only=False)
        count = np.where(code.is_valid().to_numpy(zero_copy_only=False), self.begin[at + 1] - self.begin[at], 0)
        times = np.maximum(count, 1)
        row = np.repeat(np.arange(len(keys)), times)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        place = np.full(len(row), -1)
        known = count[row] > 0
        place[known] = self.order[self.begin[at[row[known]]] + nth[known]]
        return row, place

    def take(self, places: np.ndarray) -> pa.Array:
        return self.vectors.take(pa.array(places, mask=places < 0))


def _products(left: pa.Array, right: pa.Array) -> pa.Array:
    """Rounded dot products row by row; a score that is no number is no score."""
    known = pc.and_(pc.is_valid(left), pc.is_valid(right))
    score = np.full(len(left), np.nan)
    if pc.any(known).as_py():
        at = known.to_numpy(zero_copy_only=False)
        if not at.all():
            left, right = left.filter(known), right.filter(known)
        size = pc.list_value_length(left)[0].as_py()
        products = np.einsum("ij,ij->i", _matrix(left, size), _matrix(right, size))
        score[at] = np.round(products, SCORE_DIGITS) + 0.0
    return pa.array(score, mask=~np.isfinite(score))


def _apart(batch: pa.RecordBatch, items: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The rows behind the items, which come first in a task and go to ``items``."""
    cut = int(np.count_nonzero(batch.column("_side").to_numpy() == 0))
    if cut:
        items.append(batch.slice(0, cut).select(["item", "_iv"]))
    return batch.slice(cut)


def _joined(parts: list[pa.RecordBatch], column: str) -> pa.Array:
    return pa.concat_arrays([p.column(column) for p in parts])


def _score_rows(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        items = users = None
        for batch in batches:
            batch = _apart(batch, held)
            if not len(batch):
                continue
            if items is None:
                held = held or [batch.slice(0, 0)]
                items = Lookup(_joined(held, "item"), _joined(held, "_iv"))
                held = []
            side = batch.column("_side").to_numpy()
            own, rows = batch.filter(pa.array(side == 1)), batch.filter(pa.array(side == 2))
            ids, vectors = own.column("user_id"), own.column("_uv")
            if users is not None and len(users.ids):
                # rows of a user may go on in the next batch
                last = pc.equal(users.ids, users.ids[-1])
                ids = pa.concat_arrays([users.ids.filter(last), ids])
                vectors = pa.concat_arrays([users.vectors.filter(last), vectors])
            users = Lookup(ids, vectors)
            row, user = users.find(rows.column("user_id"))
            again, item = items.find(rows.column("item").take(pa.array(row)))
            score = _products(users.take(user[again]), items.take(item))
            rows = rows.select(kept).take(pa.array(row[again]))
            yield pa.RecordBatch.from_arrays([*rows.columns, score], names=[*kept, "score"])

    return run


def score_candidates(candidates: DataFrame, users: DataFrame, item_vectors: DataFrame) -> DataFrame:
    """Dot product of user and item vector for each candidate row (user_id, item, ...).

    Every candidate stays: the score is null if the user or the item has no vector or the product is not finite. Candidates
    move once, as they are, to the task of their slice of users and block of items. There the block, ``BLOCK_BYTES`` of
    float32 vectors at most, comes first; then follow user by user a vector and its candidates, which are scored
    batch by batch. So no vector rides on a candidate row: users are copied once per block, items once per slice.
    """
    held = item_vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("size")).first()
    blocks = max(1, math.ceil(held["n"] / rows_per_block(held["size"] or 1)))
    slices = max(1, int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks)
    fields = candidates.schema.fields
    kept = [f.name for f in fields]
    # where the frames differ in the type of a key, both have the wider one, for its hash tells the place
    kinds = {k: candidates.select(k).unionAll(v.select(k)).schema[k].dataType for k, v in (("user_id", users), ("item", item_vectors))}
    user, item = (F.col(k).cast(kind) for k, kind in kinds.items())
    mine = F.pmod(F.xxhash64(user), F.lit(slices)).cast("int") * blocks
    block = F.pmod(F.xxhash64(item), F.lit(blocks)).cast("int")
    rows = candidates.select("*", F.lit(2).alias("_side"), (mine + block).alias("_slot")).withColumns({"user_id": user, "item": item})
    known = users.where("user_id IS NOT NULL").select(user.alias("user_id"), F.col("vec").alias("_uv"), mine.alias("_of"))
    known = known.select("user_id", "_uv", F.lit(1).alias("_side"), F.explode(F.sequence("_of", F.col("_of") + blocks - 1)).alias("_slot"))
    items = item_vectors.select(item.alias("item"), F.col("vec").alias("_iv"), block.alias("_of"))
    places = F.sequence("_of", F.col("_of") + (slices - 1) * blocks, F.lit(blocks))
    items = items.select("item", "_iv", F.lit(0).alias("_side"), F.explode(places).alias("_slot"))
    placed = rows.unionByName(known, allowMissingColumns=True).unionByName(items, allowMissingColumns=True)
    placed = placed.repartitionById(slices * blocks, "_slot").drop("_slot")
    placed = placed.sortWithinPartitions("user_id", "_side")  # items have no user: null comes first
    schema = StructType([*(StructField(f.name, kinds.get(f.name, f.dataType)) for f in fields), StructField("score", DoubleType())])
    scored = placed.mapInArrow(_score_rows(kept), schema)
    return scored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], "score")


def masked_mean_pool(items: DataFrame, codes: str, vectors: DataFrame, dim: int) -> DataFrame:
    """Per item the mean of the vectors of its category codes; code 0 is padding and does not count.

    An item with padding only gets the zero vector.
    """
    exploded = items.select("item", F.explode(codes).alias("code")).where("code > 0")
    known = exploded.join(vectors.select(F.col("item").alias("code"), "vec"), "code")
    pooled = known.groupBy("item").agg(_mean_vector("vec", F.lit(1.0)).alias("pooled"))
    zero = F.array_repeat(F.lit(0.0), dim)
    return items.select("item").join(pooled, "item", "left").withColumn("pooled", F.coalesce("pooled", zero))


def _best_of_block(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        catalog = None
        for batch in batches:
            batch = _apart(batch, held)
            if len(batch) and held:
                ids = _joined(held, "item").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                catalog = Catalog.of(ids[order], _stack(_joined(held, "_iv").take(pa.array(order)).to_pandas()))
                held = []
            if catalog is None:
                continue
            for lo in range(0, len(batch), _USERS_AT_ONCE):
                part = batch.slice(lo, _USERS_AT_ONCE)
                users = pd.DataFrame({"vec": part.column("_uv").to_pandas(), "seen": part.column("seen").to_pandas()})
                best = best_rows(users.assign(user_id=np.arange(len(part))), catalog, k)
                columns = [
                    part.column("user_id").take(pa.array(best["user_id"].to_numpy(dtype=np.int64))),
                    pa.array(best["item"].to_numpy(dtype=np.int64)),
                    pa.array(best["score"].to_numpy(dtype=np.float64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["user_id", "item", "score"])

    return run


def _stack(vectors: pd.Series) -> np.ndarray:
    """Vectors as float32 rows; a missing one is a row of NaN."""
    size = next((len(v) for v in vectors if v is not None), 0)
    if any(v is not None and len(v) != size for v in vectors):
        raise ValueError("vectors must have the same length")
    return np.stack([np.full(size, np.nan, np.float32) if v is None else np.asarray(v, np.float32) for v in vectors])


@dataclass
class Catalog:
    """Items by falling norm, those without a finite vector apart; ``place`` is the place of the item of each rank by id."""

    ids: np.ndarray
    matrix: np.ndarray
    norms: np.ndarray
    without: np.ndarray
    all_ids: np.ndarray
    place: np.ndarray
    products: int = 0

    @classmethod
    def of(cls, ids: np.ndarray, matrix: np.ndarray) -> Catalog:
        """``ids`` ascend."""
        finite = np.isfinite(matrix).all(axis=1)
        norms = np.zeros(len(ids))
        for lo in range(0, len(ids), _ITEMS_AT_ONCE):
            norms[lo : lo + _ITEMS_AT_ONCE] = np.linalg.norm(matrix[lo : lo + _ITEMS_AT_ONCE].astype(np.float64), axis=1)
        order = np.flatnonzero(finite)
        order = order[np.argsort(-norms[order], kind="stable")]
        place = np.full(len(ids), -1)
        place[order] = np.arange(len(order))
        return cls(ids[order], matrix[order], norms[order], ids[~finite], ids, place)


def best_rows(users: pd.DataFrame, catalog: Catalog, k: int) -> pd.DataFrame:
    """The best ``k`` unseen items of each user, exactly, without meeting the whole catalog.

    Items are worked through by falling norm, in parts that grow. A product is at most the user's norm times that of the
    part's first item, so a user whose k-th score so far is above that leaves; the search ends with the last user.
    Seen items are masked by position. A product that is not finite has no score and ranks behind all that have one.
    ``catalog.products`` counts the products taken.
    """
    n = len(users)
    vectors = np.stack(users["vec"].to_numpy()).astype(np.float64)
    finite = np.isfinite(vectors).all(axis=1)
    length = np.where(finite, np.linalg.norm(np.where(finite[:, None], vectors, 0.0), axis=1), 0.0)
    unseen = [np.zeros(0, np.int64) if s is None else np.asarray(s, np.int64) for s in users["seen"]]
    places = [catalog.place[np.searchsorted(catalog.all_ids, s)] for s in unseen]
    row, score, item = (np.zeros(0, kind) for kind in (np.int64, np.float64, np.int64))
    kth = np.full(n, -np.inf)
    lo, width = 0, _FIRST_ITEMS
    while lo < len(catalog.ids):
        # a hair more than the bound: products are rounded, and an equal score with a smaller id would win
        reach = length * catalog.norms[lo] * (1 + 1e-9) + 10.0**-SCORE_DIGITS
        active = np.flatnonzero(finite & (kth <= reach))
        if not len(active):
            break
        part = catalog.matrix[lo : lo + width].astype(np.float64)
        catalog.products += len(active) * len(part)
        new = np.round(vectors[active] @ part.T, SCORE_DIGITS) + 0.0
        for r, u in enumerate(active):
            p = places[u]
            new[r, p[(p >= lo) & (p < lo + len(part))] - lo] = -np.inf
        least = kth[active]
        if len(part) > k:
            least = np.maximum(least, np.partition(new, len(part) - k, axis=1)[:, len(part) - k])
        r, c = np.nonzero((new >= least[:, None]) & np.isfinite(new))
        row, score = np.concatenate((row, active[r])), np.concatenate((score, new[r, c]))
        item = np.concatenate((item, catalog.ids[lo + c]))
        order = np.lexsort((item, -score, row))
        row, score, item = row[order], score[order], item[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < k
        row, score, item, rank = row[kept], score[kept], item[kept], rank[kept]
        full = rank == k - 1
        kth[row[full]] = score[full]
        lo, width = lo + width, min(2 * width, _ITEMS_AT_ONCE)
    held = np.bincount(row, minlength=n)
    for u in np.flatnonzero(held < k):  # what has no score comes last, by id
        rest = catalog.without if finite[u] else catalog.all_ids
        rest = rest[~np.isin(rest, unseen[u])][: k - held[u]]
        row, item = np.append(row, np.full(len(rest), u)), np.append(item, rest)
        score = np.append(score, np.full(len(rest), np.nan))
    return pd.DataFrame({"user_id": users["user_id"].to_numpy()[row], "item": item, "score": score})


def rows_per_block(size: int, memory: int = BLOCK_BYTES) -> int:
    """Vectors of ``size`` float32 numbers that fit into ``memory``."""
    return max(1, memory // (4 * max(1, size)))


def top_k_items(
    users: DataFrame,
    item_vectors: DataFrame,
    pairs: DataFrame,
    k: int = 10,
    *,
    size: int,
    n_items: int,
    n_users: int,
    item_block: int | None = None,
    user_slice: int | None = None,
) -> DataFrame:
    """Per user the ``k`` best unseen items of the whole catalog, ranked 1..k.

    Catalog and users are hashed into blocks and slices that fill ``BLOCK_BYTES`` with vectors of ``size`` numbers; a task
    holds one block of items, meets one slice of users batch by batch, leaving out items that cannot reach a user's k-th score
    (``best_rows``), and returns ``k`` rows per user, so scored pairs never leave the task, nothing is broadcast, the catalog
    may grow and memory does not depend on the number of users. Users are copied once per block of items and items once per
    slice of users.
    Scores are compared after rounding, ties go to the smaller item. An item whose score is not finite is ranked behind
    all others, with a null score. ``pairs`` are the interaction counts of the users; stage them, they are read here and for
    the user vectors. ``n_items`` and ``n_users`` (or upper bounds) only size the blocks.
    """
    blocks = max(1, math.ceil(n_items / (item_block or rows_per_block(size))))
    slices = max(1, math.ceil(n_users / (user_slice or rows_per_block(size))))
    tasks = item_vectors.sparkSession.sparkContext.defaultParallelism
    if user_slice is None and blocks * slices < tasks:
        # small inputs: still one slice for each core
        slices = math.ceil(tasks / blocks)

    def block(item: str) -> Column:
        return F.pmod(F.xxhash64(item), F.lit(blocks)).cast("int")

    # a block holds its items once, so a user's seen list per block is no longer than the block
    seen = (
        pairs.select("user_id", "item")
        .join(item_vectors.select("item"), "item", "left_semi")
        .groupBy("user_id", block("item").alias("_block"))
        .agg(F.collect_list("item").alias("seen"))
    )
    left = users.select(
        F.lit(1).alias("_side"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("vec").alias("_uv"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
        F.pmod(F.xxhash64("user_id"), F.lit(slices)).cast("int").alias("_slice"),
    ).join(seen, ["user_id", "_block"], "left")
    right = item_vectors.select(
        F.lit(0).alias("_side"),
        F.col("item").cast("long").alias("item"),
        F.col("vec").cast("array<float>").alias("_iv"),
        block("item").alias("_block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"),
    )
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_slot", F.col("_slice") * blocks + F.col("_block"))
    both = both.repartitionById(slices * blocks, "_slot").sortWithinPartitions("_side")
    both = both.select("_side", "user_id", "_uv", F.col("seen").cast("array<long>").alias("seen"), "item", "_iv")
    best = both.mapInArrow(_best_of_block(k), "user_id long, item long, score double")
    best = best.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    order = [F.col("score").desc_nulls_last(), F.col("item")]
    return first_rows_per_key(best, ["user_id"], order, k, "rank").select("user_id", "rank", "item", "score")


def describe_recommendations(
    ranked: DataFrame, index: DataFrame, catalog: DataFrame, target_time: int = 1
) -> DataFrame:
    """Original movie ids with title, genres and slot label; items without an original id are dropped."""
    return (
        ranked.join(index.select("movie_id", F.col("item_idx").alias("item")), "item")
        .join(catalog.select("movie_id", "title", "genres"), "movie_id", "left")
        .select(
            "user_id",
            "rank",
            "movie_id",
            title_or_default(F.col("title"), F.col("movie_id")).alias("title"),
            genre_text(F.col("genres")).alias("genres"),
            "score",
            time_slot_label(F.lit(target_time)).alias("time_slot"),
        )
    )
