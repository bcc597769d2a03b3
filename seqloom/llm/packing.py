"""Best-fit packing of token pieces into sequences, improved by swap-based local search."""

from __future__ import annotations

import base64
import functools
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import slices
from seqloom.session import materialize

CAPACITY = 2048
#: Pieces packed together, and the share of a sequence that may stay free in the first rounds.
GROUP, LOOSE = 8192, 1 / 16
END_ID = 0
END_OF_TEXT = "<|endoftext|>"
CACHED_WORDS = 200_000
#: A space that does not start a token: before another white space or at the end.
LOOSE_SPACE = re.compile(r" (?:\s|\Z)")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.cache
def _encoder(ranks_path: str):
    """``text -> ids`` as little-endian 32-bit integers, the same ids that the vocabulary's JSON file gives.

    Runs of letters start a token at each single space, so a text without loose spaces can be cut there and its words
    encoded one by one; repeated words come from a bounded cache.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
    )
    cache: dict[str, bytes] = {}

    def whole(text: str) -> bytes:
        ids = bpe.encode(text, allowed_special="all") if END_OF_TEXT in text else bpe.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(text: str) -> bytes:
        if END_OF_TEXT in text or LOOSE_SPACE.search(text):
            return whole(text)
        if len(cache) > CACHED_WORDS:
            cache.clear()
        first, *words = text.split(" ")
        out = [whole(first)] if first else []
        for word in words:
            ids = cache.get(word)
            if ids is None:
                ids = whole(" " + word)
                if len(word) < 64:
                    cache[word] = ids
            out.append(ids)
        return b"".join(out)

    return encode


def token_pieces(docs: DataFrame, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each text's ids and the end id 0, cut if above ``capacity``.

    A text above the capacity is cut from its end into whole pieces, so only its first piece may be shorter. A null text is
    empty and gives the end id alone.
    """
    import public_tokenizers

    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys = batch.column(0)
            for a, b in slices(texts):
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(a, b):
                    ids = encode(texts[i]) + end
                    n = len(ids) // 4
                    at, step, k = 0, n if n <= capacity else n % capacity or capacity, 0
                    while at < n:
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(step)
                        crc.append(zlib.crc32(memoryview(ids)[4 * at : 4 * (at + step)]))
                        at, step, k = at + step, capacity, k + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, PIECES.replace("doc_id long", f"doc_id {kind}"))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers by best-fit decreasing; a bit set of the free spaces finds the tightest bin."""
    bins: list[list[int]] = []
    by_space: dict[int, list[int]] = {}
    spaces = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces &= ~(1 << space)
        else:
            space, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        by_space.setdefault(space - size, []).append(b)
        spaces |= 1 << (space - size)
    return bins


def _totals(sizes: np.ndarray) -> np.ndarray:
    """All lengths that one or two of the items have together, in order."""
    single, count = np.unique(sizes, return_counts=True)
    i, j = np.triu_indices(len(single))
    both = (single[i] + single[j])[(i != j) | (count[i] > 1)]
    return np.unique(np.concatenate((single, both)))


def _given(own: list[int], size: np.ndarray, total: int) -> list[int]:
    """One item of that length, or else two."""
    by_size: dict[int, int] = {}
    for i in own:
        if size[i] == total:
            return [i]
    for i in own:
        if (j := by_size.get(total - int(size[i]))) is not None:
            return [i, j]
        by_size[int(size[i])] = i
    raise ValueError("no such items")


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty the least filled bins by moving items, or by exchanging one or two items for a smaller one of a fuller bin.

    Every step moves length from a bin into one at least as full, the most that any step can, so the sum of squared fills grows
    and the search comes to an end. It goes through the bins from the emptiest on; each gives until it is empty or no
    step is left. It is over when the bins reach their lower bound or a pass empties none.

    Which exchanges there are is read off two lists of lengths: the totals that the bin can give, and for each length that
    could come back the largest room beside an item of it.
    """
    size = np.asarray(lengths, dtype=np.int64)
    holder = np.zeros(len(size), dtype=np.int64)
    for b, items in enumerate(bins):
        holder[items] = b
    free = capacity - np.bincount(holder, weights=size, minlength=len(bins)).astype(np.int64)
    least = math.ceil(int(size.sum()) / capacity)
    open_bins = np.flatnonzero(free > 0)  # a full bin can take nothing, so it keeps what it has
    members = {int(b): list(bins[b]) for b in open_bins}
    items = np.array([i for m in members.values() for i in m], dtype=np.int64)
    alive = len(bins)

    def move(moved: list[int], a: int, b: int) -> None:
        for i in moved:
            members[a].remove(i)
            members[b].append(i)
            holder[i] = b
            free[a] += size[i]
            free[b] -= size[i]

    def step(a: int) -> bool:
        fits = (free[open_bins] > 0) & (free[open_bins] <= free[a]) & (open_bins != a)
        others = open_bins[fits]
        if not len(others):
            return False
        room = free[others]
        movable = [i for i in members[a] if size[i] <= room.max()]
        if movable:
            item = max(movable, key=lambda i: size[i])
            move([item], a, int(others[np.where(room >= size[item], room, capacity + 1).argmin()]))
            return True
        usable = np.zeros(len(bins), dtype=np.int64)
        usable[others] = room
        beside = usable[holder[items]]
        most = np.zeros(capacity + 1, dtype=np.int64)
        np.maximum.at(most, size[items], beside)
        back = np.flatnonzero(most)
        totals = _totals(size[members[a]])
        at = np.searchsorted(totals, back + most[back], "right") - 1
        gain = np.where(at >= 0, totals[at] - back, 0)
        k = int(gain.argmax())
        if gain[k] <= 0:
            return False
        given = _given(members[a], size, int(totals[at[k]]))
        item = int(items[np.flatnonzero((size[items] == back[k]) & (beside >= gain[k]))[0]])
        b = int(holder[item])
        move([item], b, a)
        move(given, a, b)
        return True

    emptied = True
    while emptied and alive > least:
        emptied = False
        for a in sorted(members, key=lambda b: -free[b]):
            while alive > least and members[a] and step(a):
                pass
            if not members[a]:
                del members[a]
                open_bins = open_bins[open_bins != a]
                alive -= 1
                emptied = True
            if alive <= least:
                break
    return [members.get(b, items) for b, items in enumerate(bins) if b in members or free[b] == 0]


def _pack_group(turn: int, capacity: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        lengths = rows["length"].tolist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        loose = np.zeros(len(rows), dtype=bool)
        for number, items in enumerate(bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = (turn << 58) + (int(key[0]) << 20) + number, at
                at += lengths[i]
            loose[items] = capacity - at > LOOSE * capacity
        return rows.drop(columns="pack").assign(sequence_id=sequence, offset=offset, loose=loose)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each sequence holds up to ``capacity`` tokens without gaps.

    Pieces are dealt at random (by a hash of their place in the written table) to groups of about ``group`` pieces with
    the same mix of lengths; each group is packed in one task by best-fit decreasing and then improved. Pieces of sequences
    that are left with room for more than ``LOOSE`` of the capacity go through another round with those of other groups, until
    one group holds all of them, or half of a round's pieces stay loose because their lengths do not go together. Ties are
    broken by doc_id, piece and crc, so a rerun over the same table gives the same sequences.
    """
    left = materialize(pieces, "pieces")
    kind = dict(pieces.dtypes)["doc_id"]
    piece = PIECES.replace("doc_id long", f"doc_id {kind}")
    done, count = [], left.count()
    while True:
        n, turn = max(1, math.ceil(count / group)), len(done)
        place = F.xxhash64(F.input_file_name(), F.monotonically_increasing_id())

        dealt = left.withColumn("pack", F.pmod(place, F.lit(n))).groupBy("pack")
        packed = dealt.applyInPandas(_pack_group(turn, capacity), f"{piece}, sequence_id long, offset long, loose boolean")
        if n == 1:
            done.append(packed.drop("loose"))
            break
        packed = materialize(packed, "packed")
        loose = packed.where("loose").count()
        if not loose or loose > count / 2:
            done.append(packed.drop("loose"))
            break
        done.append(packed.where("NOT loose").drop("loose"))
        left, count = materialize(packed.where("loose").select(*pieces.columns), "pieces"), loose
    return functools.reduce(DataFrame.unionByName, done)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place in a sequence; see ``token_pieces`` and ``pack``.

    Rows that repeat a document are packed as often as they occur. Extra columns are ignored; an empty table gives an
    empty result.
    """
    return pack(token_pieces(docs, capacity=capacity), capacity)
