"""Chunked hot groups must give what one window over the group gives."""

import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import features, index, skew
from seqloom.operators.features import DAY, FeatureView


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    keys = [1] * 180 + [2] * 90 + [rng.randrange(3, 40) for _ in range(200)] + [99]
    return [(k, rng.randrange(60), i, rng.choice([None, i])) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, t int, id int, v int").repartition(5)


@pytest.mark.parametrize("max_rows", [10, 50, 1_000])
def test_number_rows(frame, rows, max_rows):
    got = skew.number_rows(frame, ["k"], ["t", "id"], max_rows=max_rows)
    got = {(r.k, r.id): (r.pos, r.n) for r in got.collect()}
    want = {}
    for k in {r[0] for r in rows}:
        mine = sorted((r[1], r[2]) for r in rows if r[0] == k)
        want |= {(k, i): (pos, len(mine)) for pos, (_, i) in enumerate(mine, 1)}
    assert got == want


@pytest.mark.parametrize("max_rows", [10, 1_000])
def test_fill_forward(frame, rows, max_rows):
    got = {r.id: r.v for r in skew.fill_forward(frame, ["k"], ["t", "id"], ["v"], max_rows=max_rows).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        last = None
        for _, t, i, v in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            last = v if v is not None else last
            want[i] = last
    assert got == want


def test_all_rows_of_one_time_are_still_chunked(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), F.lit(5).alias("t"), "id")
    split = skew.split_hot_groups(df, ["k"], ["t", "id"], max_rows=20)
    assert split.hot.select(skew.CHUNK).distinct().count() > 10
    got = skew.number_rows(df, ["k"], ["t", "id"], max_rows=20).where("pos = id + 1 AND n = 300")
    assert got.count() == 300


@pytest.mark.parametrize("max_rows", ["7", "100000"])
def test_dense_index_in_ranges(spark, max_rows):
    spark.conf.set(skew.HOT_GROUP_ROWS, max_rows)
    try:
        ids = [5, 900, -3, 17, 5, 17, None, *range(1000, 1200, 3)]
        df = spark.createDataFrame([(i,) for i in ids], "id long")
        got = {r.id: r.item_idx for r in index.dense_index(df, "id").collect()}
        want = {v: i for i, v in enumerate(sorted({i for i in ids if i is not None}), 1)}
        assert got == want
    finally:
        spark.conf.unset(skew.HOT_GROUP_ROWS)


def test_last_rows_per_key(frame, rows):
    got = {(r.k, r.id, r._rn) for r in skew.last_rows_per_key(frame, ["k"], ["t", "id"], 3).collect()}
    want = set()
    for k in {r[0] for r in rows}:
        mine = sorted(((r[1], r[2]) for r in rows if r[0] == k), reverse=True)[:3]
        want |= {(k, i, rn) for rn, (_, i) in enumerate(mine, 1)}
    assert got == want


def test_rank_filter_cuts_before_the_exchange(frame):
    plan = skew.last_rows_per_key(frame, ["k"], ["t", "id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2




def _pit(spark, events, feats, ttl, max_rows=None):
    view = FeatureView("f", "user_id", "ts", ["v"], ttl_seconds=ttl, tie=["tie"])
    joined = features.point_in_time_join(
        spark.createDataFrame(events, "id int, user_id int, s double").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))),
        "user_id",
        "ts",
        [(
            spark.createDataFrame(feats, "user_id int, s double, tie int, v double").withColumn("ts", F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))),
            view,
        )],
        max_rows=max_rows,
    )
    return {r.id: r.f__v for r in joined.collect()}


def test_point_in_time_borders(spark):
    ttl = DAY
    feats = [(1, 1000.0, 0, 1.0), (1, 1000.0, 1, 2.0), (2, 0.0, 0, 5.0)]
    events = [
        (0, 1, 999.0),
        (1, 1, 1000.0),
        (2, 1, 1000.0 + ttl),
        (3, 1, 1000.0 + ttl + 0.000001),
        (4, 2, float(ttl)),
        (5, 3, 50.0),
    ]
    assert _pit(spark, events, feats, ttl) == {0: None, 1: 2.0, 2: 2.0, 3: None, 4: 5.0, 5: None}


@pytest.mark.parametrize("max_rows", [15, None])
def test_point_in_time_against_search(spark, max_rows):
    rng = random.Random(3)
    users = [1] * 60 + list(range(2, 12)) * 4
    feats = [(rng.choice(users), float(rng.randrange(500)), i, float(i)) for i in range(150)]
    events = [(i, rng.choice(users), float(rng.randrange(500))) for i in range(120)]
    want = {}
    for i, user, t in events:
        past = [f for f in feats if f[0] == user and f[1] <= t]
        newest = max(past, key=lambda f: (f[1], f[2]), default=None)
        want[i] = newest[3] if newest and t - newest[1] <= 40 else None
    assert _pit(spark, events, feats, 40, max_rows) == want


def test_attach_views_looks_static_views_up(spark):
    events = spark.createDataFrame([(1, 5), (2, 5)], "user_id int, s int").withColumn("ts", F.timestamp_seconds("s"))
    rows = spark.createDataFrame([(1, 9, 7), (1, 1, 6)], "user_id int, s int, v int").withColumn("ts", F.timestamp_seconds("s"))
    moving = FeatureView("m", "user_id", "ts", ["v"])
    fixed = FeatureView("f", "user_id", "ts", ["v"], static=True)
    got = features.attach_views(events, "user_id", "ts", [(rows, moving), (rows, fixed)])
    assert {(r.user_id, r.m__v, r.f__v) for r in got.collect()} == {(1, 6, 7), (2, None, None)}


def test_unknown_entities_match_nothing(spark):
    feats = [(None, 0.0, 0, 9.0), (1, 0.0, 0, 1.0)]
    events = [(0, None, 5.0), (1, 1, 5.0), (2, 2, 5.0)]
    for max_rows in (None, 1):
        assert _pit(spark, events, feats, DAY, max_rows) == {0: None, 1: 1.0, 2: None}


def test_a_hot_null_key_is_cut(spark):
    rows = [(None if i % 4 else i, i) for i in range(160)]
    df = spark.createDataFrame(rows, "k int, i int")
    split = skew.split_hot_groups(df, ["k"], ["i"], max_rows=10)
    assert split.hot.where("k is null").count() == 120 == split.hot.count()
    assert split.cold.where("k is null").count() == 0
    got = skew.number_rows(df, ["k"], ["i"], max_rows=10).where("k is null").orderBy("i").collect()
    assert [r.pos for r in got] == list(range(1, 121)) and {r.n for r in got} == {120}
