"""The prefix trie of conversations against a plain walk."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from seqloom.llm import prefixtree

SCHEMA = "conv_id long, turn long, role string, text string, key string, block int"


def expected(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
            convs[c].append(((turn is not None, turn or 0, digest), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    rebuilt = {c: own.get(c - int(math.fmod(c, 100)), [])[: h[c]] + own[c][h[c] :] for c in own}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = sum(saved[k] for k in children[n]) + ((len(members[n]) - 1) * len(n[-1][1]) if n else 0)
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def found(frame, size=prefixtree.BLOCK):
    rebuilt = prefixtree.share_openings(prefixtree.ordered_turns(frame))
    out = prefixtree.prefix_tree(frame, rebuilt, size)
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def test_whole_table(spark, sf):
    frame = spark.read.parquet(f"{sf}/conversations.parquet")
    assert found(frame) == expected(map(tuple, frame.collect()))


@pytest.mark.parametrize("size", [1, 3, 4])
def test_random_conversations(spark, size):
    rng = random.Random(size)
    rows = []
    for c in rng.sample(range(-120, 420), 150):
        for t in range(rng.choice([1, 2, 5, 7, 13])):
            text = rng.choice(["", None, "a", "bb", "\U0001f600é", "c" * 50]) if rng.random() < 0.3 else f"t{t % 4}"
            rows.append((c, rng.choice([None, t, t]), rng.choice(["user", None]) if rng.random() < 0.2 else "user", text, "x", 1))
    rows += [(300 + i, t, "user", f"same {t}", None, None) for i in range(60) for t in range(9)]  # a group of copies
    rows += [(None, 1, "user", "nobody", None, None)] + rows[:20]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame, size) == expected(rows)


def test_hot_conversation_and_hot_ends(spark, monkeypatch):
    monkeypatch.setattr(prefixtree, "CHUNK_IDS", 7)
    rows = [(100, t, "user", f"long {t}") for t in range(700)] + [(7, t, "user", f"long {t}") for t in range(400)]
    rows += [(200 + i, 0, "user", "same") for i in range(99)]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(4)
    spark.conf.set("spark.seqloom.hotGroupRows", "100")
    try:
        got = found(frame)
    finally:
        spark.conf.unset("spark.seqloom.hotGroupRows")
    assert got == expected(rows)


def test_nothing(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    rows = [(3, None, None, None, None, None)]  # h is 5 and there is no conversation 0: a root without turns
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)
