"""Prefix trie of conversations: blocks of turns are grouped first, single turns only where sibling blocks part."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.skew import CHUNK, number_rows, split_hot_groups
from seqloom.session import materialize

#: Turns of a block.
BLOCK = 4
#: A shared opening has fewer turns than this.
OPENINGS = 6
#: Ids joined to one piece of text before the piece goes to the task that hashes them.
CHUNK_IDS = 50_000
WORDS = ["w1", "w2", "w3", "w4"]


def _digest(*parts: Column) -> Column:
    """128 bits of SHA-256 as 32 hex digits."""
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def _prefix(words: list[Column]) -> Column:
    return F.md5(F.concat_ws(":", *words))


#: Key of the node without turns.
ROOT = hashlib.md5(b"0:0:0:0").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, digest, chars)``: turns by ``turn`` (null first), numbered from 1; texts stay where they are read.

    Null roles and texts are empty. Turns of one number come in the order of their digests, repeated rows all count, and rows
    without conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.col("turn").alias("_turn"),
        _digest(F.length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    numbered = number_rows(
        turns, ["conv_id"], ["_turn", "digest"], position="pos", total=None, size_from=conversations.select("conv_id")
    )
    return numbered.drop("_turn")


def share_openings(turns: DataFrame, group: int = 100) -> DataFrame:
    """Every conversation c with the first h turns of conversation ``c - c % group`` in place of its own, h = crc32(c) % 6.

    All turns of a shorter one, none of an absent one. A conversation without any turn left has no row here.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENINGS
    openings = (
        turns.where(F.col("pos") < OPENINGS)
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("opening"))
    )
    convs = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), h.alias("h"))
    placed = convs.join(openings, "base", "left").select(
        "conv_id",
        "h",
        F.when(F.col("opening").isNull(), F.array().cast("array<struct<pos:bigint,digest:string,chars:bigint>>"))
        .otherwise(F.slice("opening", 1, F.greatest(F.col("h"), F.lit(0)).cast("int")))
        .alias("opening"),
    )
    placed = materialize(placed, "prefix-openings")
    first = placed.select("conv_id", F.inline("opening"))
    own = turns.join(placed.select("conv_id", "h", F.size("opening").alias("n")), "conv_id").where("pos > h")
    return first.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "digest", "chars"))


def _running(df: DataFrame, keys: list[str], order: list[str], columns: list[str], sized: DataFrame) -> DataFrame:
    """Each of ``columns`` as its sum up to and with the row, per key; hot keys in chunks."""
    split = split_hot_groups(df, keys, order, size_from=sized)
    upto = (Window.unboundedPreceding, Window.currentRow)
    parts = []
    if split.cold is not None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        parts.append(split.cold.withColumns({f"to_{c}": F.sum(c).over(w) for c in columns}))
    if split.hot is not None:
        sums = split.hot.groupBy(*keys, CHUNK).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select(*keys, CHUNK, *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in columns])
        w = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(*upto)
        hot = split.hot.join(sums, [*keys, CHUNK])
        hot = hot.withColumns({f"to_{c}": F.sum(c).over(w) + F.col(f"_{c}") for c in columns})
        parts.append(hot.drop(CHUNK, *[f"_{c}" for c in columns]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """``(conv_id, block, turns, parent, node, before, upto)``: runs of ``size`` turns, the last one may be shorter.

    ``parent`` and ``node`` are keys of the whole sequence of turns before the block and up to its end; ``before`` and ``upto``
    are its code points. A key is the sum of position-bound digests of blocks, so that it is a running sum and a
    conversation of any length is done in chunks.
    """
    made = (
        turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / size).alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("turns"))
        .withColumn("chars", F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["chars"]))
    )
    joined = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    made = made.withColumn("own", _digest(F.col("block").cast("string"), F.lit(":"), joined))
    words = {w: F.conv(F.substring("own", 8 * i + 1, 8), 16, 10).cast("long") for i, w in enumerate(WORDS)}
    made = made.withColumns(words).drop("own")
    run = _running(made, ["conv_id"], ["block"], [*WORDS, "chars"], turns.select("conv_id"))
    return run.select(
        "conv_id",
        "block",
        "turns",
        _prefix([F.col(f"to_{w}") - F.col(w) for w in WORDS]).alias("parent"),
        _prefix([F.col(f"to_{w}") for w in WORDS]).alias("node"),
        (F.col("to_chars") - F.col("chars")).alias("before"),
        F.col("to_chars").alias("upto"),
    )


def _turn_key(n: Column, digests: Column, parent: Column, node: Column, size: int) -> Column:
    """Key of the node after ``n`` turns of a block: that of the next block's parent where the block is full."""
    inner = _digest(parent, F.lit("/"), F.array_join(F.slice(digests, 1, n), ""))
    return F.when(n == 0, parent).when(n == size, node).otherwise(inner)


def _by_turn(groups: DataFrame, size: int, *carried: str) -> DataFrame:
    """One row per turn of each block group: key, key of the turn before, depth, characters and those before it."""
    digests = F.transform("turns", lambda t: t["digest"])
    rows = F.transform(
        "turns",
        lambda t, i: F.struct(
            _turn_key((i + 1).cast("int"), digests, F.col("parent"), F.col("node"), size).alias("key"),
            _turn_key(i.cast("int"), digests, F.col("parent"), F.col("node"), size).alias("above"),
            (F.col("block") * size + i + 1).cast("long").alias("depth"),
            t["chars"].alias("chars"),
            (
                F.col("before") + F.aggregate(F.slice("turns", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["chars"])
            ).alias("start"),
        ),
    )
    return groups.select(*carried, F.inline(rows))


def _hashed_ids(rows: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of ``(key, conv_id)``: SHA-256 of the ids in order, comma-joined.

    Ranges of (key, id) are joined to pieces of text where they are sorted; one task then feeds a key's pieces to its hash,
    one after another, so no list of ids is ever held.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def cut() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"key": key, "first": ids[0], "piece": ",".join(map(str, ids))}])

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (k != key or len(ids) >= CHUNK_IDS):
                    yield cut()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield cut()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(piece.encode())
            if out:
                yield pa.RecordBatch.from_pydict({"key": [k for k, _ in out], "ends_sha256": [s for _, s in out]})
        if state:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [state.hexdigest()]})

    ranged = rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    cut = ranged.mapInArrow(pieces, "key string, first long, piece string")
    return cut.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashes, "key string, ends_sha256 string")


def prefix_tree(conversations: DataFrame, rebuilt: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``rebuilt`` turns; conversations of ``conversations`` without any are at the root.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    Blocks of conversations are grouped by the digest of everything up to their end, so copies of any number are one row from
    there on. A block without siblings holds the same conversations at each of its turns and is not refined; only
    blocks that part from siblings are opened turn by turn and grouped again. Sums over subtrees need no walk over depths:
    a conversation saves what it holds before the depth at which it becomes the smallest member of its nodes. Empty tables
    have no node.
    """
    made = materialize(blocks(rebuilt, size), "prefix-blocks")
    groups = made.groupBy("node", "parent", "block", "before", "upto").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")
    )
    alone = (
        groups.groupBy("parent").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node")).where("k = 1").select("node")
    )
    groups = groups.join(alone.withColumn("lone", F.lit(True)), "node", "left")
    groups = materialize(groups.withColumn("lone", F.coalesce("lone", F.lit(False))), "prefix-groups")

    ids = ["key", "above", "depth", "chars", "start"]
    opened = _by_turn(groups.where("NOT lone"), size, "n_convs", "conv_id")
    opened = opened.groupBy(*ids).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    kept = _by_turn(groups.where("lone"), size, "n_convs", "conv_id").select(opened.columns)
    children = F.col("above"), F.count(F.lit(1)).alias("n_children")
    nodes = materialize(opened.unionByName(kept), "prefix-nodes")
    counted = nodes.groupBy(children[0].alias("key")).agg(children[1])
    nodes = materialize(
        nodes.join(counted, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "prefix-nodes",
    )

    # per conversation: where it ends, what it holds before it leads its nodes, and whether it leads a node without children
    everyone = conversations.where("conv_id IS NOT NULL").select("conv_id").distinct()
    digests = F.transform("turns", lambda t: t["digest"])
    end = _turn_key(F.size("turns"), digests, F.col("parent"), F.col("node"), size)
    last = made.groupBy("conv_id").agg(F.max(F.struct("block", "upto", end.alias("key"))).alias("last"))
    leads = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "start")).alias("lead"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    convs = (
        everyone.join(last, "conv_id", "left")
        .join(leads, "conv_id", "left")
        .select(
            "conv_id",
            F.coalesce("last.key", F.lit(ROOT)).alias("key"),
            F.coalesce("lead.start", "last.upto", F.lit(0)).alias("held"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
        )
    )
    convs = materialize(convs, "prefix-convs")

    # blocks again, now with what lies beyond them: only the smallest member of a group can stop inside it
    beyond = made.select("conv_id", "node", "upto").join(convs.select("conv_id", "held", "leaf"), "conv_id")
    beyond = beyond.groupBy("node").agg(
        F.sum(F.greatest(F.col("held") - F.col("upto"), F.lit(0))).alias("after"),
        F.min("held").alias("least"),
        F.sum("leaf").alias("n_leaves"),
    )
    groups = groups.drop("conv_id").join(beyond, "node")
    stops = F.col("least") < F.col("upto")
    saved = (
        F.col("after")
        + (F.col("upto") - F.col("start")) * (F.col("n_convs") - stops.cast("long"))
        + F.when(stops, F.greatest(F.col("least") - F.col("start"), F.lit(0))).otherwise(0)
    )
    sums = ["after", "least", "n_leaves", "n_convs", "upto"]
    opened = _by_turn(groups.where("NOT lone"), size, *sums).groupBy("key")
    opened = opened.agg(F.sum("n_leaves").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))
    kept = _by_turn(groups.where("lone"), size, *sums).select("key", "n_leaves", saved.alias("saved_tokens"))

    ends = _hashed_ids(convs)
    nothing = hashlib.sha256(b"").hexdigest()
    top = convs.agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("leaf").alias("leaves"),
        F.sum("held").alias("saved_tokens"),
    ).where("n_convs > 0")
    first = nodes.where(F.col("depth") == 1).agg(F.count(F.lit(1)).alias("n_children"))
    top = top.crossJoin(first).select(  # one row each
        F.lit(ROOT).alias("key"),
        F.lit(None).cast("string").alias("above"),
        F.lit(0).cast("long").alias("depth"),
        "n_convs",
        "conv_id",
        "n_children",
        F.greatest("leaves", F.lit(1)).alias("n_leaves"),
        "saved_tokens",
    )
    below = nodes.join(opened.unionByName(kept), "key").select(top.columns)
    whole = materialize(below.unionByName(top), "prefix-tree")
    parents = whole.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return (
        whole.join(parents, "above", "left")
        .join(ends, "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
