"""SimHash near-duplicates over a Gray-order hierarchical index."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components, map_texts
from seqloom.session import materialize

BITS, DISTANCE, SHINGLE, HASH_SEED = 64, 3, 3, 42
#: Fingerprints below one root node in one task; a fuller root is split into pairs of such parts.
ROOT_ROWS = 8192
#: Children of a node, and (query, node) pairs held at once.
FANOUT, PAIRS = 16, 2_000_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 majority bits of the XXH64 hashes of all word shingles, repeats included; 0 for a text without words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), HASH_SEED)]
    else:
        runs = zip(*(itertools.islice(words, k, None) for k in range(shingle)), strict=False)
        hashes = [digest(b" ".join(run), HASH_SEED) for run in runs]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` without its text and with ``fp``, the fingerprint as a signed 64-bit number."""

    def run(texts: list[str]) -> dict[str, list]:
        found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
        return {"fp": found.view(np.int64)}

    return map_texts(docs, run, "fp long")


def root_masks(n: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks of the root nodes: two fingerprints within ``distance`` agree on all bits of at least one mask.

    The bits are cut into blocks, and a mask has all but ``distance`` of them. More blocks make more copies of each
    fingerprint but fewer fingerprints below a root; the count follows from the number of fingerprints. The links found do
    not depend on it.
    """
    for blocks in range(distance + 1, distance + 4):
        kept = blocks - distance
        if n / 2 ** (BITS * kept // blocks) <= ROOT_ROWS / 2:
            break
    borders = [BITS * b // blocks for b in range(blocks + 1)]
    parts = [(1 << borders[b + 1]) - (1 << borders[b]) for b in range(blocks)]
    return [sum(chosen) for chosen in itertools.combinations(parts, kept)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenated ranges ``starts[i] .. starts[i] + sizes[i]``."""
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return first + np.arange(int(sizes.sum()))


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the classes of ``a[i]`` and ``b[i]`` in ``label``, where each class is named by its smallest member."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low < high
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label[:] = jumped


def linked_classes(fps: np.ndarray, roots: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Class of each fingerprint (number of its first member) under links below the same root; rows come root by root.

    Below each root the fingerprints stand in Gray rank. Runs of them form leaf nodes, runs of nodes form upper
    nodes. A node keeps the bits that all below it share (mask and pattern), without those that a node above keeps
    already. A search goes down level by level for many queries at once and adds up each path's differences; a node whose
    sum is above ``distance`` drops out with all that is below it.
    """
    n = len(fps)
    order = np.lexsort((gray_rank(fps), roots))
    x, root = fps[order], roots[order]
    # level 0: the fingerprints; then runs of up to FANOUT nodes of one root, until each root is one node
    low, high, owner = x, x, root
    levels = []
    while True:
        new = np.concatenate(([True], owner[1:] != owner[:-1]))
        if levels and new.all():
            break
        begin = np.flatnonzero(new)
        within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
        starts = np.flatnonzero(within % FANOUT == 0)
        sizes = np.diff(np.append(starts, len(owner)))
        low, high, owner = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts), owner[starts]
        levels.append([starts, sizes, ~(low ^ high), low])
    shared = levels[0][2]
    below = np.repeat(~shared, levels[0][1])
    for lower, upper in itertools.pairwise(levels):  # factor out what the node above has
        shared = upper[2]
        lower[2] = lower[2] & ~np.repeat(shared, upper[1])
    of_root = np.searchsorted(owner, root)
    members = np.bincount(of_root)[of_root]
    label = np.arange(n)
    limit = np.uint8(distance)
    cost = np.cumsum(members)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(cost, (cost[start - 1] if start else 0) + PAIRS, side="right")))
        query = np.arange(start, stop)
        node, differences = of_root[query], np.zeros(stop - start, dtype=np.uint8)
        for level in reversed(levels):
            differences = differences + np.bitwise_count((x[query] ^ level[3][node]) & level[2][node])
            near = differences <= limit
            query, node, differences = query[near], node[near], differences[near]
            sizes = level[1][node]
            children = _ragged(level[0][node], sizes)
            query, differences, node = np.repeat(query, sizes), np.repeat(differences, sizes), children
        differences = differences + np.bitwise_count((x[query] ^ x[node]) & below[node])
        near = (differences <= limit) & (node > query)
        merge(label, query[near], node[near])
        start = stop
    out = np.empty(n, dtype=np.int64)
    out[order] = order[label]
    return out


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints of ``fps(fp)``, enough to connect all that are within ``distance``.

    Each fingerprint goes below one root node per mask. Roots are dealt to tasks; a root with more than ``ROOT_ROWS``
    fingerprints is cut into parts by a hash, and each pair of parts is searched on its own. A task returns a
    spanning star of each class it finds, at most one edge per fingerprint, never the pairs of a group.
    """
    n = fps.count()
    masks = root_masks(n, distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    below = fps.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)))).alias("r")
    ).select("fp", "r.mask", "r.bits")
    full = below.groupBy("mask", "bits").count().where(F.col("count") > ROOT_ROWS)
    full = full.select("mask", "bits", F.ceil(F.col("count") / ROOT_ROWS).cast("int").alias("parts"))
    below = below.join(full, ["mask", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    below = below.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    root = F.xxhash64("mask", "bits", F.least("part", "other"), F.greatest("part", "other"))
    # a root's number is a hash; if two roots shared one, the search would only see more fingerprints than it has to
    below = below.select("fp", root.alias("root"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def flush(fp: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
            to = linked_classes(fp.view(np.uint64), at, distance)
            moved = fp[to] != fp
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[to][moved])], names=["u", "v"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows < 8 * ROOT_ROWS:
                continue
            fp, at = (np.concatenate(c) for c in zip(*held, strict=True))
            whole = int(np.searchsorted(at, at[-1]))  # the last root may go on in the next batch
            if whole:
                yield flush(fp[:whole], at[:whole])
            held, rows = [(fp[whole:], at[whole:])], len(fp) - whole
        if rows:
            yield flush(*(np.concatenate(c) for c in zip(*held, strict=True)))

    dealt = below.repartition("root").sortWithinPartitions("root")
    return dealt.mapInArrow(run, "u long, v long")


def as_hex(fp: str) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    Fingerprints that differ in up to three bits are linked; ``component_id`` is the smallest doc_id that links reach.
    Equal fingerprints are one node, so copies cost nothing beyond their own rows, and the rows of a hot fingerprint
    meet it in a join that may be split. Null and empty texts have fingerprint 0. Repeated rows are repeated in the
    result. A null doc_id counts only where its component has no other id (then component_id is null).
    """
    return groups(docs.select("doc_id", "text")).select("doc_id", as_hex("fp").alias("fingerprint"), "component_id")


def groups(docs: DataFrame) -> DataFrame:
    """``docs`` without text and with ``fp``, ``root`` (a fingerprint that names the component) and ``component_id``."""
    rows = materialize(fingerprints(docs), "simhash")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes.select("fp")), "simhash-links")
    nodes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    nodes = nodes.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(nodes, "fp")
