"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components
from seqloom.llm.simhash import merge
from seqloom.session import materialize

THRESHOLD, BLOCK, SEED = 0.98, 8, 5
#: Vectors of a cell in one part; a fuller cell is searched as pairs of parts.
CELL_ROWS = 8192
#: Rows of a distance matrix, and candidate pairs whose whole vectors are compared, at once.
TILE, PAIRS = 1024, 50_000
#: Room for rounding when distances stand in for cosines, and where they are taken in single precision. Cosines
#: themselves are compared exactly.
SLACK, SINGLE_SLACK = 1e-9, 1e-5


@functools.cache
def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, so that no block of coordinates is likelier to hold the differences."""
    q, r = np.linalg.qr(np.random.default_rng((seed, size)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def blocks(size: int, width: int = BLOCK) -> list[slice]:
    n = max(1, round(size / width))
    return [slice(size * b // n, size * (b + 1) // n) for b in range(n)]


def budgets(size: int, threshold: float, width: int = BLOCK) -> np.ndarray:
    """Squared distance that each block may have: unit vectors at the threshold differ by ``2 - 2 threshold``, and each
    block gets the part that its dimensions have. A pair within the whole budget is within it in one block at least."""
    whole = 2 - 2 * threshold + SLACK
    return np.array([whole * (b.stop - b.start) / size for b in blocks(size, width)]) + SLACK


def grid_dimensions(per_label: float, width: int = BLOCK) -> int:
    """Coordinates of a block that the cells cut: none for few vectors, one more for each four times as many.

    The links found do not depend on it.
    """
    return min(width, max(0, math.ceil(math.log(max(per_label, 1) / (8 * CELL_ROWS), 4))))


def _cells(y: np.ndarray, part: slice, budget: float, dims: int) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Rows, cells and whether the row is at home there, for all cells of a block that a vector's ball meets."""
    if not dims:
        return np.arange(len(y)), [], np.ones(len(y), dtype=bool)
    reach = math.sqrt(budget)
    side = 4 * reach
    lead = y[:, part][:, :dims]
    home = np.floor(lead / side).astype(np.int64)
    low, high = np.floor((lead - reach) / side).astype(np.int64), np.floor((lead + reach) / side).astype(np.int64)
    at, cells, own = [], [], []
    for i in range(len(y)):
        for cell in itertools.product(*(range(a, b + 1) for a, b in zip(low[i].tolist(), high[i].tolist(), strict=True))):
            at.append(i)
            cells.append(",".join(map(str, cell)))
            own.append(cell == tuple(home[i].tolist()))
    return np.array(at, dtype=np.int64), cells, np.array(own, dtype=bool)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _matrix(lists: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def _near(z: np.ndarray, limit: float, part: np.ndarray, cross: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a block within ``limit``, each once; with ``cross`` only pairs of different parts.

    One single-precision product of extended rows gives minus half the squared distance of each pair of a tile.
    """
    half = np.einsum("ij,ij->i", z, z)[:, None] / 2
    one = np.ones_like(half)
    left = np.concatenate([z, -half, one], axis=1).astype(np.float32)
    right = np.concatenate([z, one, -half], axis=1).astype(np.float32)
    least = np.float32(-(limit + SINGLE_SLACK) / 2)
    if cross:
        first, second = (np.flatnonzero(part == p) for p in np.unique(part)[[0, -1]])
        for top in range(0, len(first), TILE):
            rows = first[top : top + TILE]
            i, j = np.nonzero(left[rows] @ right[second].T >= least)
            yield rows[i], second[j]
        return
    for top in range(0, len(z), TILE):
        i, j = np.nonzero(left[top : top + TILE] @ right[top:].T >= least)
        later = j > i
        yield i[later] + top, j[later] + top


def _pairs_of_cell(
    unit: np.ndarray, ids: np.ndarray, home: np.ndarray, part: np.ndarray, cross: bool, block: int, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs that belong to this cell and block: each pair of the table comes out of one cell alone.

    A pair counts where the vector of the larger id is at home and in the first block whose budget it meets.
    """
    size = unit.shape[1]
    y = unit @ rotation(size)
    parts, limits = blocks(size), budgets(size, threshold)
    if cross and len(np.unique(part)) < 2:
        return
    for a, b in _near(y[:, parts[block]], limits[block], part, cross):
        a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
        own = home[b] & (ids[a] != ids[b])
        a, b = a[own], b[own]
        for at in range(0, len(a), PAIRS):
            i, j = a[at : at + PAIRS], b[at : at + PAIRS]
            gap = (y[i] - y[j]) ** 2
            first = gap[:, parts[block]].sum(axis=1) <= limits[block]
            for earlier in range(block):
                first &= gap[:, parts[earlier]].sum(axis=1) > limits[earlier]
            i, j = i[first], j[first]
            linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            yield i[linked], j[linked]


def usable(vector: str | Column) -> Column:
    """Whether a vector has components, all finite, that are not all zero."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def link(classes: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Per vector ``(node, links)`` and edges ``(u, v)`` from ``classes(node, label, embedding, copies)``.

    Every vector goes once into each block (low-dimensional, after the rotation), and there to the cells that its budget
    reaches; the range join of a block runs inside the cells. Candidates are checked on the whole vectors in double
    precision at once, so pairs never leave the task: it returns sums of copies linked to each vector and a spanning star
    of each class found. Cells with more than ``CELL_ROWS`` vectors are cut into parts, and each pair of parts is a cell.
    """
    per_label = classes.groupBy("label", F.size("embedding").alias("size")).count().agg(F.max("count")).first()[0] or 0
    dims = grid_dimensions(per_label)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0)
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == size)
                y = _unit(_matrix(vectors.take(pa.array(of)), size)) @ rotation(size)
                for b, (part, limit) in enumerate(zip(blocks(size), budgets(size, threshold), strict=True)):
                    at, cells, home = _cells(y, part, limit, min(dims, part.stop - part.start))
                    rows = pa.array(of[at])
                    columns = [batch.column(k).take(rows) for k in range(batch.num_columns)]
                    names = [f"{size}:{b}:{c}" for c in cells] if dims else pa.repeat(f"{size}:{b}", len(at))
                    added = [pa.repeat(pa.scalar(b, pa.int32()), len(at)), pa.array(names, pa.string()), pa.array(home)]
                    yield pa.RecordBatch.from_arrays(columns + added, names=[*batch.schema.names, "block", "cell", "home"])

    kinds = dict(classes.dtypes)
    base = f"embedding {kinds['embedding']}, node {kinds['node']}, label {kinds['label']}, copies long"
    placed = classes.select("embedding", "node", "label", "copies").mapInArrow(
        spread, base + ", block int, cell string, home boolean"
    )
    full = placed.groupBy("label", "cell").count().where(F.col("count") > CELL_ROWS)
    full = full.select("label", "cell", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("parts"))
    placed = placed.join(full, ["label", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    placed = placed.select("label", "cell", low, high, "part", "block", "home", "node", "copies", "embedding")
    cell = ["label", "cell", "low", "high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            begin = 0
            for i, key in enumerate(keys):
                if key != last:
                    if i > begin:
                        held.append(batch.slice(begin, i - begin))
                    if held:
                        yield found(pa.Table.from_batches(held))
                    held, begin, last = [], i, key
            held.append(batch.slice(begin))
        if held:
            yield found(pa.Table.from_batches(held))

    def found(rows: pa.Table) -> pa.RecordBatch:
        ids, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        unit = _unit(_matrix(rows["embedding"], len(rows["embedding"][0])))
        home = rows["home"].to_numpy(zero_copy_only=False)
        part = rows["part"].to_numpy()
        cross = rows["low"][0].as_py() != rows["high"][0].as_py()
        links, label = np.zeros(len(ids), dtype=np.int64), np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        by_rank = np.sort(ids)
        classes = np.arange(len(ids))
        for i, j in _pairs_of_cell(unit, ids, home, part, cross, rows["block"][0].as_py(), threshold):
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            merge(classes, label[i], label[j])
        some = links > 0
        columns = [pa.array(ids[some]), pa.array(by_rank[classes[label[some]]]), pa.array(links[some])]
        return pa.RecordBatch.from_arrays(columns, names=["node", "root", "links"])

    dealt = placed.repartition(*cell).sortWithinPartitions(*cell)
    hits = materialize(dealt.mapInArrow(search, f"node {kinds['node']}, root {kinds['node']}, links long"), "vector-links")
    sums = hits.groupBy("node").agg(F.sum("links").alias("links"))
    return sums, hits.select(F.col("node").alias("u"), F.col("root").alias("v")).where("u <> v")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label)``.

    Vectors of one label (not null) and size are linked when their cosine, in double precision, reaches ``threshold``.
    Equal vectors of a label are one class and are compared once: each member has the others as links, and all copies of
    the classes that its class is linked with. ``component_id`` is the smallest vec_id that links reach.

    Vectors that are null, zero or hold null or non-finite components link with nothing, nor do those of a null label or a
    null vec_id; they get no link and their own id. Rows that repeat a vec_id count as vectors of their own, and all get
    the figures of that id's class. Extra columns are ignored.
    """
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("embedding")
    rows = vectors.select("vec_id", "label", "embedding", good.alias("good"))
    classes = rows.where("good").groupBy("label", "embedding")
    classes = materialize(classes.agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    sums, edges = link(classes, threshold)
    roots = components(edges, "vector-components")
    figures = (
        classes.join(sums, "node", "left")
        .join(roots, "node", "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("embedding").alias("of_embedding"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    same = F.col("good") & (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding"))
    joined = rows.join(figures, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
