"""Fingerprints under edit distance: a shared random walk over characters, sampled bits, banding and verification."""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import components, map_texts, written
from seqloom.llm.simhash import merge
from seqloom.session import delete_path, materialize

SEED = 11
#: Walks per text. After an edit a walk may take long to fall into step again; the likeness is that of the best walk.
WALKS = 2
#: The walk's random tables repeat after so many steps.
PERIOD = 8192
#: Sampled steps in each octave (from a power of two to the next), and octaves at most.
SAMPLES, OCTAVES = 128, 40
#: Characters walked side by side, and the number of walks from which they go on one by one.
WALK_CHARS, ALONE = 16_000_000, 8
#: Bits of a band, and bands of each kind, for up to ``FEW_NODES`` different fingerprints; a walk has two kinds.
BAND_BITS, BANDS, FEW_NODES = 20, 16, 65_536
#: Nodes of a band in one task (a fuller band is split into pairs of such parts), of a band compared side by side with
#: others, and rows searched at once.
PART_ROWS, FEW, HELD = 1024, 16, 65_536
#: Members of a band up to which all are compared in one task; those of a fuller one first meet its smallest.
SMALL = 128
LIKENESS = 0.8


@functools.cache
def tables(number: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each step and character class: whether walk ``number`` moves on, and the bit that it writes.

    Class 0 stands behind the end of every text; there the walk stays.
    """
    rng = np.random.default_rng((SEED, number))
    moves = rng.integers(0, 2, (PERIOD, 256), dtype=np.int64)
    moves[:, 0] = 0
    return moves, rng.integers(0, 2, (PERIOD, 256), dtype=np.uint8)


@functools.cache
def sampled_steps(octave: int) -> np.ndarray:
    """Steps of an octave that are written down: all of a short one, evenly spread random ones of a long one."""
    low = 1 << octave
    if low <= SAMPLES:
        return np.arange(low, 2 * low)
    edges = low + low * np.arange(SAMPLES + 1) // SAMPLES
    return np.random.default_rng((SEED, octave)).integers(edges[:-1], edges[1:])


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mixed = (points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return np.append((mixed % np.uint64(255) + np.uint64(1)).astype(np.uint8), np.uint8(0))


def walk(texts: list[str], number: int = 0) -> list[list[np.ndarray]]:
    """Sampled bits of each text, octave by octave, up to the octave in which its walk ends.

    All walks share their random choices: at step ``t`` on a character the bit and whether to move on depend on ``t``
    and the character alone. So after an edit two walks soon fall into step again, and texts a few edits apart agree in most
    steps. Texts of a batch are walked side by side, one step of all of them at a time.
    """
    moves, bits = tables(number)
    coded = [_classes(t) for t in texts]
    size = np.array([len(c) for c in coded])
    flat = np.concatenate(coded) if coded else np.zeros(0, dtype=np.uint8)
    end = np.cumsum(size) - 1
    at = end - size + 1
    out: list[list[np.ndarray]] = [[] for _ in texts]
    live = np.flatnonzero(size > 1)
    at, end = at[live], end[live]
    # step 0 is not sampled
    for octave in range(OCTAVES):
        if not len(live):
            break
        if octave == 0:
            at = at + moves[0][flat[at]]
        low = 1 << octave
        steps = sampled_steps(octave)
        wanted = dict(zip(steps.tolist(), range(len(steps)), strict=True))
        got = np.zeros((len(steps), len(live)), dtype=np.uint8)
        alive = np.ones(len(live), dtype=bool)
        col = np.arange(len(live))
        pos, stop = at.copy(), end.copy()
        t = low
        while t < 2 * low and len(col):
            if len(col) <= ALONE:
                for c, p, e in zip(col.tolist(), pos.tolist(), stop.tolist(), strict=True):
                    at[c] = _walk_alone(flat, p, e, t, 2 * low, wanted, got[:, c], number)
                    alive[c] = at[c] < e
                col, pos = col[:0], pos[:0]
                break
            until = min(t + 64, 2 * low)
            while t < until:
                here = flat[pos]
                row = t % PERIOD
                if t in wanted:
                    got[wanted[t], col] = np.where(here > 0, bits[row][here], 0)
                pos += moves[row][here]
                t += 1
            going = pos < stop
            if not going.all():
                done = col[~going]
                at[done] = stop[~going]
                alive[done] = False
                col, pos, stop = col[going], pos[going], stop[going]
        at[col] = pos
        for c, d in enumerate(live.tolist()):
            out[d].append(got[:, c])
        live, at, end = live[alive], at[alive], end[alive]
    return out


def _walk_alone(
    flat: np.ndarray, pos: int, stop: int, t: int, until: int, wanted: dict[int, int], got: np.ndarray, number: int
) -> int:
    """One walk, in plain Python: cheaper than array steps when few walks are left."""
    moves, bits = _plain_tables(number)
    text = flat[pos : stop + 1].tobytes()
    i = 0
    n = len(text) - 1
    while t < until and i < n:
        here = text[i]
        row = t % PERIOD
        if t in wanted:
            got[wanted[t]] = bits[row][here]
        i += moves[row][here]
        t += 1
    return pos + i


@functools.cache
def _plain_tables(number: int) -> tuple[list[bytes], list[bytes]]:
    moves, bits = tables(number)
    return [r.astype(np.uint8).tobytes() for r in moves], [r.tobytes() for r in bits]


#: The octaves of each walk of a text.
Print = list[list[np.ndarray]]


def to_text(walks: Print) -> str:
    """Sampled bits as hex, octaves apart by dots and walks by slashes; the empty text for one without characters."""
    return "/".join(".".join(np.packbits(o).tobytes().hex() for o in octaves) for octaves in walks if octaves)


def fingerprint_all(texts: list[str]) -> list[Print]:
    """All walks over slices of texts of about ``WALK_CHARS``, texts of like length together; equal texts walk once."""
    distinct = sorted(set(texts), key=len)
    found: dict[str, Print] = {}
    start = size = 0
    for i, t in enumerate([*distinct, ""]):
        if i == len(distinct) or size + len(t) > WALK_CHARS and i > start:
            part = distinct[start:i]
            walks = [walk(part, number) for number in range(WALKS)]
            found.update((text, list(own)) for text, own in zip(part, zip(*walks, strict=True), strict=True))
            start, size = i, 0
        size += len(t)
    return [found[t] for t in texts]


def likeness(a: Print, b: Print) -> float:
    """Likeness of two texts, 0 to 1: that of the walk that kept most in step."""
    return max(map(walk_likeness, a, b), default=1.0) if len(a) == len(b) else 0.0


def walk_likeness(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Estimated share of steps in which two texts agree beyond chance on one walk, 0 to 1.

    Octaves count by their number of steps; an octave that one walk does not reach agrees nowhere. Two bits of unrelated
    walks agree half the time, which is taken off. Texts without characters are like each other alone.
    """
    if not a or not b:
        return float(len(a) == len(b))
    agree = total = 0.0
    for octave in range(max(len(a), len(b))):
        weight = float(1 << octave)
        total += weight
        if octave < min(len(a), len(b)):
            agree += weight * float((a[octave] == b[octave]).mean())
        else:
            agree += weight / 2
    return max(0.0, min(1.0, 2 * agree / total - 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` without its text and with ``fingerprint``; null texts are empty and have an empty one."""

    def run(texts: list[str]) -> dict[str, list]:
        return {"fingerprint": [to_text(w) for w in fingerprint_all(texts)]}

    return map_texts(docs, run, "fingerprint string")


def parse(fingerprint: str) -> Print:
    """The walks that ``to_text`` wrote; of a text without characters, walks without octaves."""

    def octaves(walk: str) -> list[np.ndarray]:
        parts = [np.frombuffer(bytes.fromhex(part), dtype=np.uint8) for part in walk.split(".")]
        return [np.unpackbits(part)[: len(sampled_steps(k))] for k, part in enumerate(parts)]

    return [octaves(w) for w in fingerprint.split("/")] if fingerprint else [[] for _ in range(WALKS)]


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, chunks: int) -> DataFrame:
    """``(chunk, guest, doc_id, text)``, so that the rows of a chunk by (guest, doc_id descending, text) follow on.

    Chunks are ranges of doc_id of about the same number of rows; their borders come from one pass over the ids. Each
    chunk also gets, as its guest, the first row of the chunk after it (the last chunk the first row of all), so a task
    has the successor of every row that it owns. Only the borders and the first ids of the chunks go through the driver,
    one of each per chunk. Null ids come last.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    place = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("double").alias("place"))
    ids = place.select("place").where("place is not null").repartitionByRange(chunks, "place")
    tops = ids.groupBy(F.spark_partition_id()).agg(F.min("place").alias("low")).select("low").collect()
    borders = [float("-inf"), *sorted({r["low"] for r in tops})[1:], float("inf")]
    last = len(borders) - 1  # the chunk of the null ids
    if len(borders) > 2:
        cut = Bucketizer(splits=borders, inputCol="place", outputCol="range", handleInvalid="keep")
        place = cut.transform(place)
    else:
        place = place.withColumn("range", F.when(F.col("place").isNotNull(), F.lit(0)))
    place = place.withColumn("chunk", F.coalesce(F.col("range").cast("int"), F.lit(last)))
    firsts = place.groupBy("chunk").agg(F.max("doc_id").alias("first")).collect()
    row = sorted(firsts, key=lambda r: (r["chunk"] == last, -r["chunk"]))
    chain = [(row[(k + 1) % len(row)]["first"], r["chunk"]) for k, r in enumerate(row)]
    kind = dict(docs.dtypes)["doc_id"]
    guests = spark.createDataFrame(chain, f"first {kind}, host int")
    # one row per chunk: small enough to send to every task
    both = place.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    own = F.struct(F.col("chunk").alias("chunk"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("host").alias("chunk"), F.lit(1).alias("guest"))
    spots = F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    return both.withColumn("spot", F.explode(spots)).select("spot.chunk", "spot.guest", "doc_id", "text")


COMPARED = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_next(docs: DataFrame, chunks: int | None = None) -> DataFrame:
    """Each text's fingerprint, that of the text edited with the next document's, and how near both and the next are.

    The next document is the one with the next smaller doc_id, after the last the first; rows that share a doc_id follow on
    by text. A single row is its own next. Null texts are empty. Whole texts move once, to the task of their range of ids.
    """
    chunks = chunks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(docs.dtypes)["doc_id"]
    placed = in_order(docs, chunks).repartitionById(chunks + 1, "chunk")  # and one of null ids
    placed = placed.sortWithinPartitions("chunk", "guest", F.col("doc_id").desc_nulls_last(), "text")
    names = [c.split()[0] for c in COMPARED.split(", ")]

    def pairs(rows: list[tuple]) -> pa.RecordBatch:
        keep = [i for i, (a, b) in enumerate(itertools.pairwise(rows)) if a[0] == b[0] and not a[1]]
        texts = [r[3] for r in rows]
        changed = [edited(texts[i], texts[i + 1]) for i in keep]
        prints = fingerprint_all(texts + changed)
        out: dict[str, list] = {n: [] for n in names}
        for k, i in enumerate(keep):
            mine, other, following = prints[i], prints[len(rows) + k], prints[i + 1]
            values = (
                len(texts[i]),
                hashlib.sha256(changed[k].encode("utf-8", "surrogatepass")).hexdigest(),
                to_text(mine),
                to_text(other),
                likeness(mine, other),
                likeness(mine, following),
            )
            for n, v in zip(names, values, strict=True):
                out[n].append(v)
        columns = [pa.array([rows[i][2] for i in keep], id_type[0])]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns += [pa.array(out[n], t) for n, t in zip(names, types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    id_type: list[pa.DataType] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            id_type[:] = [batch.column(2).type]
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                held.append(row)
                size += len(row[3])
                if size > WALK_CHARS // 2 and len(held) > 1:
                    yield pairs(held)
                    held, size = [row], len(row[3])
        if len(held) > 1:
            yield pairs(held)

    return placed.mapInArrow(run, f"doc_id {kind}, {COMPARED}")


def octave_bytes(octaves: int) -> np.ndarray:
    """Bytes of each octave of a walk with so many."""
    return np.array([-(-len(sampled_steps(k)) // 8) for k in range(octaves)], dtype=np.int64)


@functools.cache
def _octaves_of() -> dict[int, int]:
    return {int(octave_bytes(n).sum()): n for n in range(1, OCTAVES + 1)}


def band_shape(nodes: int, least: float) -> tuple[int, int]:
    """Bits of a band, and bands of each kind, for so many different fingerprints.

    Unrelated walks share a band of b bits once in 2^b times, so a band is one bit wider for each doubling, and a walk
    meets as many by chance in a large corpus as in a small one. Walks of likeness ``least`` agree in (1 + least) / 2 of their
    bits, in what a band draws from at times in less (0.05 is taken off), and in that power fewer of the wider bands. As many
    more bands are taken, so they are found as often.
    """
    wider = math.ceil(math.log2(max(nodes, FEW_NODES) / FEW_NODES))
    return BAND_BITS + wider, round(BANDS / ((1 + least) / 2 - 0.05) ** wider)


def band_keys(
    packed: np.ndarray, octaves: int, number: int, width: int = BAND_BITS, bands: int = BANDS
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``width`` sampled bits and the row of each, for walks of the same number of octaves (packed, row by row).

    Bits of longer octaves are drawn more often, as they count for more. Half of the bands take bits of the octaves before
    the last one, which a walk has passed whole. The others also take bits of the first half of the last octave, if the
    walk goes on behind it, and else are further bands of the octaves before: bits behind the end of a walk are 0 for
    everybody and never drawn. A walk of few octaves has all its bits drawn from.
    """
    sizes = [len(sampled_steps(k)) for k in range(octaves)]
    first = np.concatenate(([0], np.cumsum(octave_bytes(octaves)) * 8))
    bits = np.unpackbits(packed, axis=1)
    half = sizes[-1] // 2
    beyond = bits[:, first[octaves - 1] + half : first[octaves]].any(axis=1)
    tiny = sum(sizes[:-1]) < 2 * width
    power = 1 << np.arange(width, dtype=np.int64)
    keys, rows = [], []
    for kind in range(3):  # octaves before the last, more of them, with the half of the last
        held = np.flatnonzero([np.ones(len(bits), dtype=bool), ~beyond, beyond][kind])
        upto = octaves if tiny or kind == 2 else octaves - 1
        room = np.array([float(1 << k) for k in range(upto)])
        depth = sizes[:upto]
        if kind == 2 and not tiny:
            room[-1], depth[-1] = room[-1] / 2, half
        rng = np.random.default_rng((SEED, number, octaves, kind))
        at = np.repeat(first[:upto], depth) + np.concatenate([np.arange(d) for d in depth])
        chance = np.repeat(room / np.array(depth), depth)
        for b in range(bands):
            drawn = rng.choice(at, min(width, len(at)), replace=False, p=chance / chance.sum())
            value = bits[np.ix_(held, drawn)].astype(np.int64) @ power[: len(drawn)]
            keys.append((((number * 64 + octaves) * 3 + kind) * bands + b << width) + value)
            rows.append(held)
    return np.concatenate(keys), np.concatenate(rows)


def sketches(packed: np.ndarray, octaves: int, number: int) -> np.ndarray:
    """64 bits of each walk, drawn like its likeness weighs them, to tell chance meetings in a band from near texts."""
    sizes = [len(sampled_steps(k)) for k in range(octaves)]
    first = np.concatenate(([0], np.cumsum(octave_bytes(octaves)) * 8))[:-1]
    at = np.repeat(first, sizes) + np.concatenate([np.arange(d) for d in sizes])
    chance = np.repeat([(1 << k) / d for k, d in enumerate(sizes)], sizes)
    drawn = np.random.default_rng((SEED, number, octaves, 9)).choice(at, min(64, len(at)), replace=False, p=chance / chance.sum())
    bits = np.zeros((len(packed), 64), dtype=np.uint8)
    bits[:, : len(drawn)] = np.unpackbits(packed, axis=1)[:, drawn]
    return np.packbits(bits, axis=1).view("<i8")[:, 0]


def sketch_distance(least: float) -> int:
    """Bits in which the sketches of two walks of that likeness differ at most, but for one pair in a million or fewer."""
    p = (1 - least) / 2
    return math.ceil(64 * p + 5.5 * math.sqrt(64 * p * (1 - p)))


def _alike(a: np.ndarray, b: np.ndarray, octaves: int, least: float) -> np.ndarray:
    """Whether packed walks of so many octaves reach a likeness, row by row."""
    step = [(1 << k) // len(sampled_steps(k)) for k in range(octaves)]
    weight = np.repeat(np.array(step, dtype=np.float64), octave_bytes(octaves))
    return 1 - 2 * (np.bitwise_count(a ^ b) @ weight) / float((1 << octaves) - 1) >= least


def linked_walks(
    packed: np.ndarray, roots: np.ndarray, octaves: int, least: float, known: np.ndarray | None = None, own: np.ndarray | None = None
) -> np.ndarray:
    """Class of each walk (number of a member) by links below the same root; rows come root by root, in it class by class.

    All pairs of a root are compared but those that links, or the classes ``known`` before, have joined already. Rows that
    are not a part's ``own`` are compared with the own ones alone.
    """
    n = len(roots)
    known = np.arange(n) if known is None else known
    own = np.ones(n, dtype=bool) if own is None else own
    begin = np.flatnonzero(np.concatenate(([True], roots[1:] != roots[:-1])))
    size = np.diff(np.append(begin, n))
    fresh = np.concatenate(([True], (roots[1:] != roots[:-1]) | (known[1:] != known[:-1])))
    label = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    of = np.repeat(size, size)
    for d in range(1, min(FEW, int(size.max()))):  # small roots side by side
        a = np.flatnonzero((roots[:-d] == roots[d:]) & (of[:-d] <= FEW) & (label[:-d] != label[d:]))
        for part in np.array_split(a, len(a) // 65536 + 1):
            part = part[_alike(packed[part], packed[part + d], octaves, least)]
            merge(label, part, part + d)
    for low, s in zip(begin[size > FEW], size[size > FEW], strict=True):
        for i in (low + np.flatnonzero(own[low : low + s])).tolist():
            open_ = label[low : low + s] != label[i]
            open_[: i - low] &= ~own[low:i]  # own rows before this one have met it
            others = low + np.flatnonzero(open_)
            if len(others):
                others = others[_alike(packed[i], packed[others], octaves, least)]
                # labels of this root only: merge moves nothing else
                local = label[low : low + s] - low
                merge(local, np.full(len(others), i - low), others - low)
                label[low : low + s] = local + low
    return label


def near_duplicates(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``(doc_id, class_id)``: documents whose fingerprints are alike; see ``with_classes``."""
    rows = fingerprints(docs.select("doc_id", "text"))
    return with_classes(materialize(rows, "edit-prints"), least).select("doc_id", "class_id")


def with_classes(rows: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``rows(doc_id, fingerprint, …)`` with ``class_id``, by bit-sampled banding and verification; ``rows`` is read twice.

    Rows of equal fingerprints are one node. Each walk of a node goes into several bands of sampled bits, wider and more of
    them as the nodes get more (``band_shape``). A band of two is left out if 64 sampled bits of both tell them apart. To the
    members of the others, and to them alone, come their whole walks, one row for each member, never for each pair: all pairs
    of a band of up to ``SMALL`` are compared in the task that holds it. Every member of a fuller band is first compared with the
    band's smallest node, each pair once for all bands that it shares: that takes time in proportion to the members and joins
    groups of near copies. Then such bands with members of more than one class are searched for the other links. Their
    largest class is dealt to parts of ``PART_ROWS`` nodes by a hash; the members of other classes are sent to each part,
    and all pairs of different classes are compared. Tasks return stars, never pairs.
    Banding finds a pair with a likelihood that grows with its likeness; what it links is verified. ``class_id`` is the
    smallest doc_id that links reach (null if there is none).

    Walks are alike above one half only if they have the same number of octaves, so ``least`` has to be above that.
    """
    if least <= 0.5:
        raise ValueError("least must be above 0.5")
    rows = rows.drop("class_id").withColumn("node", F.xxhash64("fingerprint"))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("fingerprint").alias("fingerprint"))
    nodes = materialize(nodes, "edit-nodes")
    walks = F.split(F.translate("fingerprint", ".", ""), "/")
    # a text of one walk is like others of one walk only, so that has a number of its own
    walks = F.transform(walks, lambda w, k: F.struct(F.when(F.size(walks) == WALKS, k).otherwise(WALKS).alias("number"), F.unhex(w).alias("bits")))
    walks = nodes.where("fingerprint <> ''").select("node", F.explode(walks).alias("walk")).select("node", "walk.*")
    width, bands = band_shape(nodes.count(), least)

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bits = np.array(batch.column(2).to_pylist(), dtype=object)
            size = np.array([len(b) for b in bits])
            for k, s in sorted(set(zip(number.tolist(), size.tolist(), strict=True))):
                at = np.flatnonzero((number == k) & (size == s))
                packed, octaves = _packed(bits[at]), _octaves_of()[s]
                keys, row = band_keys(packed, octaves, k, width, bands)
                columns = [pa.array(keys), pa.array(node[at][row]), pa.array(sketches(packed, octaves, k)[row])]
                yield pa.RecordBatch.from_arrays(columns, names=["band", "node", "sketch"])

    # bands are counted and joined in writes of their own, so that each step's shuffle files can go before the next;
    # only ids move by band, and walks join the members of shared bands alone
    spark = rows.sparkSession
    banded = walks.mapInArrow(band, "band long, node long, sketch long")
    counts = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("sketch").alias("apart"))
    shared = counts.where((F.col("n") > 2) | (F.col("n") == 2) & (F.bit_count("apart") <= sketch_distance(least)))
    shared, counted = written(shared.select("band", "n"), "edit-bands")
    members, placed = written(banded.select("band", "node").join(shared, "band"), "edit-members")
    delete_path(spark, counted)
    number = F.floor(F.col("band") / F.lit((3 * bands * 64) << width)).cast("int")
    members = members.withColumn("number", number)
    small, full = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a, b = (np.array([*batch.column(k).to_pylist(), None], dtype=object)[:-1] for k in (2, 3))
            size, alike = np.array([len(x) for x in a]), np.zeros(len(u), dtype=bool)
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                alike[at] = _alike(_packed(a[at]), _packed(b[at]), _octaves_of()[s], least)
            yield pa.RecordBatch.from_arrays([pa.array(u[alike]), pa.array(v[alike])], names=["u", "v"])

    smallest = full.groupBy("band").agg(F.min("node").alias("smallest"))
    pairs = full.join(smallest, "band").where("node <> smallest").select("node", "smallest", "number").distinct()
    pairs = pairs.join(walks.withColumnRenamed("bits", "a"), ["node", "number"])
    other = walks.select(F.col("node").alias("smallest"), "number", F.col("bits").alias("b"))
    pairs = pairs.join(other, ["smallest", "number"]).select("node", "smallest", "a", "b")
    links, found = written(pairs.mapInArrow(compare, "u long, v long"), "edit-links")
    roots = components(links, "edit-stars")
    delete_path(spark, found)

    # what is left of full bands: members of other classes than the largest
    classed = full.join(roots, "node", "left").select("band", "node", "number", F.coalesce("root", "node").alias("class"))
    classed, labelled = written(classed, "edit-classed")
    sizes = classed.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("band").agg(
        F.max(F.struct("n", "class"))["class"].alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")
    )
    mixed = classed.join(sizes.where("classes > 1"), "band").join(walks, ["node", "number"])
    parts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    mixed = mixed.withColumn("parts", parts).withColumn("at", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    every = F.when(F.col("class") == F.col("main"), F.array("at")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    mixed = mixed.withColumn("part", F.explode(every))
    mixed = mixed.select(F.xxhash64("band", "part").alias("root"), "class", (F.col("at") == F.col("part")).alias("own"), "bits")
    small = small.join(walks, ["node", "number"])
    small = small.select(F.xxhash64("band").alias("root"), F.col("node").alias("class"), F.lit(True).alias("own"), "bits")
    mixed = mixed.unionByName(small).repartition("root").sortWithinPartitions("root", "class")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush(root: np.ndarray, known: np.ndarray, own: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            size = np.array([len(b) for b in bits])
            found = []
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                to = linked_walks(_packed(bits[at]), root[at], _octaves_of()[s], least, known[at], own[at])
                found.append(np.stack((known[at], known[at][to]), 1))
            u, v = np.unique(np.concatenate(found), axis=0).T
            return pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            held.append((*columns, np.array([*batch.column(3).to_pylist(), None], dtype=object)[:-1]))
            count += batch.num_rows
            if count < HELD:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            whole = int(np.searchsorted(columns[0], columns[0][-1]))  # the last root may go on in the next batch
            if whole:
                yield flush(*(c[:whole] for c in columns))
            held, count = [tuple(c[whole:] for c in columns)], len(columns[0]) - whole
        if count:
            yield flush(*(np.concatenate(c) for c in zip(*held, strict=True)))

    links, found = written(mixed.mapInArrow(search, "u long, v long"), "edit-links")
    delete_path(spark, labelled)
    delete_path(spark, placed)
    links = links.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
    last = components(links, "edit-classes")
    delete_path(spark, found)
    named = nodes.select("node", "first").join(last, "node", "left")
    named = named.select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("class_id"))
    named = named.join(smallest, "root").select("node", "class_id")
    return rows.join(named, "node").drop("node")


def _packed(bits: np.ndarray) -> np.ndarray:
    """Byte strings of one length as rows."""
    return np.frombuffer(b"".join(bits.tolist()), dtype=np.uint8).reshape(len(bits), -1)
