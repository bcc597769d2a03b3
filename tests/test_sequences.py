"""Sequences, splits and history windows against a plain restatement over Python lists."""

import pytest
from pyspark.sql import functions as F

from seqloom.operators import contract, sampling, sequences

SIZES = {1: 1, 2: 3, 3: 4, 4: 5, 5: 60, 6: 230, 7: 22}


@pytest.fixture(scope="module")
def history():
    out = {}
    for user, n in SIZES.items():
        # two events share every time stamp, the id decides
        out[user] = [(100 + i // 2, user * 1000 + i, (i * 7 + user) % 40 + 1, i % 3, [i % 5, 0, 0]) for i in range(n)]
    return out


@pytest.fixture(scope="module")
def events(spark, history):
    rows = [(u, *r) for u, rs in history.items() for r in rs]
    schema = "user_id int, rating_timestamp long, event_id int, item int, slot int, genres array<int>"
    return spark.createDataFrame(rows, schema).repartition(6, F.rand(1))


def expected(history, cap, width=50, minimum=5):
    out = set()
    for user, rows in history.items():
        n = len(rows)
        if n < minimum:
            continue
        targets = {n - 1: "test", n - 2: "val"}
        oldest = 1 if cap is None else max(1, n - 2 - cap)
        targets |= {p: "train" for p in range(oldest, n - 2)}
        for p, split in targets.items():
            before = rows[max(0, p - width) : p]
            items, slots, genres = ([r[c] for r in before] for c in (2, 3, 4))
            out.add((user, split, str(items), str(slots), str(genres), rows[p][2], rows[p][3], rows[p][0]))
    return out


def collected(samples):
    return {
        (
            r.user_id,
            r.split,
            str(list(r.item_seq)),
            str(list(r.time_seq)),
            str([list(g) for g in r.genre_seq]),
            r.target,
            r.target_time,
            r.last_timestamp,
        )
        for r in samples.collect()
    }


ORDER = ["rating_timestamp", "event_id"]


@pytest.mark.parametrize("cap", [0, 3, 20, 500, 2_000])
def test_capped_samples(events, history, cap):
    assert collected(sequences.training_samples(events, ORDER, max_train_per_user=cap)) == expected(history, cap)


@pytest.mark.parametrize(("block", "max_rows"), [(100_000, None), (50, None), (64, 20)])
def test_all_samples(events, history, block, max_rows):
    got = sequences.training_samples(events, ORDER, max_train_per_user=None, block=block, max_rows=max_rows)
    assert collected(got) == expected(history, None)


def test_one_row_per_position(events):
    got = sequences.training_samples(events, ORDER, max_train_per_user=None, block=50, max_rows=20)
    assert got.count() == got.select("user_id", "from_end").distinct().count()


@pytest.mark.parametrize("max_rows", [None, 20])
def test_split_labels(events, history, max_rows):
    got = sequences.leave_one_out_split(events, ORDER, max_rows=max_rows)
    got = {(r.user_id, r.event_id): r.split for r in got.collect()}
    want = {}
    for user, rows in history.items():
        if len(rows) >= 5:
            labels = ["train"] * (len(rows) - 2) + ["val", "test"]
            want |= {(user, r[1]): label for r, label in zip(rows, labels, strict=True)}
    assert got == want


@pytest.mark.parametrize(("chunk", "max_rows"), [(1000, None), (25, 20)])
def test_sequences_are_whole(events, history, chunk, max_rows):
    parts = sequences.user_sequences(events, ORDER, chunk=chunk, max_rows=max_rows).collect()
    assert all(len(p.item_seq) <= chunk for p in parts)
    for user, rows in history.items():
        mine = sorted((p for p in parts if p.user_id == user), key=lambda p: p.part)
        items = [i for p in mine for i in p.item_seq]
        assert items == ([r[2] for r in rows] if len(rows) >= 5 else [])
        assert all(p.seq_len == len(rows) for p in mine)


def test_profiles_and_padding(spark, events):
    profiles = spark.createDataFrame(
        [(5, 1, 0, 4), (6, None, 0, 4), (7, 2, 1, 5)], "user_id int, age_idx int, gender_idx int, occupation int"
    )
    samples = sequences.training_samples(events, ORDER, profiles=profiles)
    for cap in (20, 2_000, None):
        joined = sequences.training_samples(events, ORDER, max_train_per_user=cap, profiles=profiles)
        after = sequences.attach_profile(sequences.training_samples(events, ORDER, max_train_per_user=cap), profiles)
        assert contract.difference(joined, after).count() == 0
    assert {r.user_id for r in samples.select("user_id").distinct().collect()} == {5, 7}
    row = sequences.pad_samples(samples).where("user_id = 7 AND split = 'train'").orderBy("from_end", ascending=False).first()
    assert len(row.item_seq) == len(row.time_seq) == len(row.genre_seq) == 50
    assert row.item_seq[:49] == [0] * 49 and row.item_seq[49] > 0
    assert row.genre_seq[0] == [0, 0, 0] and row.user_profile.occupation == 5


def test_empty(spark, events):
    empty = events.where("false")
    assert sequences.training_samples(empty, ORDER).count() == 0
    assert sequences.training_samples(empty, ORDER, max_train_per_user=20).count() == 0
    assert sequences.user_sequences(empty, ORDER, chunk=10).count() == 0


@pytest.mark.parametrize("shuffled", [True, False])
def test_export_is_complete_and_batched(spark, events, tmp_path, shuffled):
    samples = sequences.training_samples(events, ORDER)
    path = str(tmp_path / "export")
    sampling.training_export(samples, path, key=["user_id", "from_end"], shards=3, batch=8, shuffled=shuffled)
    back = spark.read.parquet(path)
    assert back.count() == samples.count() == back.select("user_id", "from_end").distinct().count()
    sizes = {(r.shard, r.batch): r["count"] for r in back.groupBy("shard", "batch").count().collect()}
    for shard in {s for s, _ in sizes}:
        mine = [sizes[k] for k in sorted(sizes) if k[0] == shard]
        assert all(n == 8 for n in mine[:-1]) and 1 <= mine[-1] <= 8
    if not shuffled:
        ordered = [(r.user_id, r.from_end) for r in back.orderBy("shard", "batch", "user_id", "from_end").collect()]
        assert ordered == sorted(ordered)
