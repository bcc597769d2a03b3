"""Negatives, ranks, metrics, pooling and recommendation against plain Python."""

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seqloom.operators import ranking, recommend, sampling, skew

SAMPLES = "user_id int, from_end int, target long, item_seq array<bigint>"


def test_negatives_are_eligible_and_complete(spark):
    rows = [(1, 1, 7, [3, 3, 9]), (2, 1, 1, []), (3, 2, 10, list(range(1, 10))), (4, 1, 5, [1, 2, 3, 4, 6, 7, 8, 9])]
    df = spark.createDataFrame(rows, SAMPLES)
    out = {r.user_id: r for r in sampling.negative_candidates(df, F.lit(10), negatives=300).collect()}
    for user, _, target, seen in rows:
        allowed = set(range(1, 11)) - set(seen) - {target}
        drawn = out[user].candidates[1:]
        assert out[user].candidates[0] == target
        assert set(drawn) == allowed
        assert len(drawn) == (300 if allowed else 0) and out[user].short == (not allowed)
    counts = Counter(out[2].candidates[1:])
    assert min(counts.values()) > 10


@pytest.mark.parametrize("hot", ["20", "1000000"])
def test_negatives_outside_a_long_history(spark, hot):
    spark.conf.set(skew.HOT_GROUP_ROWS, hot)
    try:
        seen = {1: {7}, 2: set(range(1, 200, 2)), 3: set(range(1, 201)), 4: {1, 2, 3, 199, 200}, 5: set(range(1, 200))}
        rows = [(u, e, max(items), []) for u, items in seen.items() for e in (1, 2)]
        pairs = spark.createDataFrame([(u, i) for u, items in seen.items() for i in items], "user_id int, item long")
        out = sampling.negatives_outside_history(spark.createDataFrame(rows, SAMPLES), pairs, F.lit(200)).collect()
        assert len(out) == 10
        for r in out:
            allowed = set(range(1, 201)) - seen[r.user_id]
            assert r.candidates[0] == max(seen[r.user_id]) and r.short == (not allowed)
            assert len(r.candidates) == (100 if allowed else 1) and set(r.candidates[1:]) <= allowed
            # the list-based draw over the same exclusion gives the same items
            listed = spark.createDataFrame([(r.user_id, r.from_end, r.target, sorted(seen[r.user_id]))], SAMPLES)
            assert sampling.negative_candidates(listed, F.lit(200)).first().candidates == r.candidates
    finally:
        spark.conf.unset(skew.HOT_GROUP_ROWS)


def test_negatives_do_not_depend_on_partitioning(spark):
    df = spark.range(40).select(
        F.col("id").cast("int").alias("user_id"), F.lit(1).alias("from_end"), F.lit(3).cast("long").alias("target"),
        F.array(F.lit(1).cast("long")).alias("item_seq"),
    )
    a, b = (sampling.negative_candidates(df.repartition(n), F.lit(50)).orderBy("user_id").collect() for n in (1, 7))
    assert a == b


def test_rank_counts_only_higher_scores(spark):
    rows = [(1, True, 0.5), (1, False, 0.5), (1, False, 0.9), (1, False, 0.1), (2, True, 0.3), (3, True, 0.1)]
    rows += [(3, False, 0.2)] * 12
    ranks = ranking.target_rank(spark.createDataFrame(rows, "s int, is_target boolean, score double"), ["s"])
    assert {r.s: r.rank for r in ranks.collect()} == {1: 2, 2: 1, 3: 13}
    m = ranking.ranking_metrics(ranks).first().asDict()
    assert m["Hit@5"] == pytest.approx(2 / 3)
    assert m["NDCG@5"] == pytest.approx((1 + 1 / math.log2(3)) / 3)
    assert m["MRR@20"] == pytest.approx((1 + 1 / 2 + 1 / 13) / 3)
    long = ranking.ranking_metrics_long(ranking.ranking_metrics(ranks)).collect()
    assert {r.metric for r in long} >= {"test_hit_at_5", "test_ndcg_at_10", "test_mrr_at_20"} and len(long) == 9


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    return {i: rng.normal(size=6).round(3) for i in range(1, 41)}


def _items(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "item long, vec array<double>")


@pytest.mark.parametrize(("item_block", "user_slice"), [(1000, 1000), (7, 3)])
def test_top_k_against_full_scores(spark, vectors, item_block, user_slice):
    history = {u: [(u * 3 + j) % 40 + 1 for j in range(u)] for u in range(1, 12)}
    history[12] = list(range(1, 41))
    history[13] = [*range(1, 37), 1, 1]
    rows = [(u, i) for u, items in history.items() for i in items]
    events = spark.createDataFrame(rows, "user_id long, item long")
    pairs = recommend.interaction_counts(events)
    users = recommend.user_vectors(pairs, _items(spark, vectors))
    got = recommend.top_k_items(users, _items(spark, vectors), pairs, 10, size=6, n_items=40, n_users=13, item_block=item_block, user_slice=user_slice)
    found = {}
    for r in got.collect():
        found.setdefault(r.user_id, {})[r.rank] = (r.item, r.score)
    for u, items in history.items():
        mean = np.mean([vectors[i] for i in items], axis=0)
        scores = sorted((-round(float(mean @ v), 6), i) for i, v in vectors.items() if i not in items)[:10]
        want = {k: (i, pytest.approx(-s, abs=2e-6)) for k, (s, i) in enumerate(scores, 1)}
        assert found.get(u, {}) == want


def test_scores_of_candidates(spark, vectors):
    users = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (2, [0.0, 2.0, 0.0, 0.0, 0.0, 0.0])], "user_id long, vec array<double>")
    cand = spark.createDataFrame([(1, 3), (2, 4), (2, 999)], "user_id long, item long")
    got = {(r.user_id, r.item): r.score for r in recommend.score_candidates(cand, users, _items(spark, vectors)).collect()}
    assert got == {(1, 3): pytest.approx(vectors[3][0]), (2, 4): pytest.approx(2 * vectors[4][1]), (2, 999): None}


def test_pooling_ignores_padding(spark, vectors):
    items = spark.createDataFrame([(1, [2, 3, 0]), (2, [0, 0, 0])], "item long, codes array<int>")
    got = {r.item: r.pooled for r in recommend.masked_mean_pool(items, "codes", _items(spark, vectors), 6).collect()}
    assert got[1] == pytest.approx(list((vectors[2] + vectors[3]) / 2)) and got[2] == [0.0] * 6


def test_unseen_and_described(spark):
    cand = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id long, item long")
    seen = spark.createDataFrame([(1, 1), (1, 1), (3, 2)], "user_id long, item long")
    assert {tuple(r) for r in recommend.unseen_candidates(cand, seen).collect()} == {(1, 2), (2, 1)}
    ranked = spark.createDataFrame([(1, 1, 10, 0.5), (1, 2, 11, 0.4), (1, 3, 12, 0.3)], "user_id long, rank int, item long, score double")
    index = spark.createDataFrame([(100, 10), (101, 11)], "movie_id long, item_idx long")
    catalog = spark.createDataFrame([(100, "A", ["X", "Y"])], "movie_id long, title string, genres array<string>")
    rows = recommend.describe_recommendations(ranked, index, catalog).orderBy("rank").collect()
    assert [(r.movie_id, r.title, r.genres, r.time_slot) for r in rows] == [
        (100, "A", "X|Y", "Prime Time (18:00-21:59)"),
        (101, "Movie 101", "Unknown", "Prime Time (18:00-21:59)"),
    ]


def test_split_share_and_subset(spark):
    df = spark.range(5000)
    share = sampling.hash_split(df, ["id"]).where("split = 'test'").count() / 5000
    assert 0.17 < share < 0.23
    assert sampling.eligible_subset(df, "id").count() == 200
    assert sampling.eligible_subset(spark.range(30), "id").count() == 30


def test_a_target_without_score_comes_last(spark):
    rows = [(1, True, None), (1, False, 0.5), (1, False, None), (2, True, 0.2), (2, False, None), (2, False, 0.1)]
    ranks = ranking.target_rank(spark.createDataFrame(rows, "s int, is_target boolean, score double"), ["s"])
    assert {r.s: r.rank for r in ranks.collect()} == {1: 3, 2: 1}


def test_candidates_without_vector_stay(spark):
    candidates = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (1, 3)], "user_id long, item long")
    users = spark.createDataFrame([(1, [1.0, 2.0])], "user_id long, vec array<double>")
    items = spark.createDataFrame([(1, [3.0, 4.0]), (3, [float("nan"), 1.0])], "item long, vec array<double>")
    got = {(r.user_id, r.item): r.score for r in recommend.score_candidates(candidates, users, items).collect()}
    assert got == {(1, 1): 11.0, (1, 2): None, (2, 1): None, (1, 3): None}


def test_vectors_of_unequal_length_are_refused(spark):
    candidates = spark.createDataFrame([(1, 1), (1, 2)], "user_id long, item long").coalesce(1)
    users = spark.createDataFrame([(1, [1.0, 2.0])], "user_id long, vec array<double>")
    items = spark.createDataFrame([(1, [3.0, 4.0, 5.0]), (2, [1.0])], "item long, vec array<double>")
    with pytest.raises(Exception, match="same length"):
        recommend.score_candidates(candidates, users, items).collect()


def test_scores_that_are_not_finite_rank_last(spark):
    items = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [float("nan"), 0.0]), (3, [2.0, 0.0]), (4, [float("inf"), 0.0])], "item long, vec array<double>"
    )
    users = spark.createDataFrame([(7, [1.0, 1.0])], "user_id long, vec array<double>")
    pairs = spark.createDataFrame([(7, 1, 1)], "user_id long, item long, weight long")
    got = recommend.top_k_items(users, items, pairs, 10, size=2, n_items=4, n_users=1, item_block=2, user_slice=1)
    assert [(r.rank, r.item, r.score) for r in got.orderBy("rank").collect()] == [(1, 3, 2.0), (2, 2, None), (3, 4, None)]


def test_blocks_fill_memory():
    assert recommend.rows_per_block(64) == 128 * 1024 * 1024 // 256
    assert recommend.rows_per_block(10**9) == 1


def test_split_does_not_depend_on_the_time_zone(spark):
    df = spark.range(300).select(F.timestamp_seconds(F.col("id") * 7919).alias("t"), "id")
    try:
        splits = []
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            splits.append({r.id: r.split for r in sampling.hash_split(df, ["t"]).collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert splits[0] == splits[1]


def test_a_user_without_pairs_draws_from_all_items(spark):
    samples = spark.createDataFrame([(1, 1, 3, []), (2, 1, 4, [])], SAMPLES)
    pairs = spark.createDataFrame([(1, 3)], "user_id int, item long")
    out = {r.user_id: r for r in sampling.negatives_outside_history(samples, pairs, F.lit(50)).collect()}
    assert len(out[2].candidates) == 100 and not out[2].short
    assert set(out[2].candidates) <= set(range(1, 51))


def _plain_best(users, ids, matrix, k):
    out = []
    for user, vec, seen in users:
        with np.errstate(invalid="ignore"):
            scores = np.round(matrix.astype(np.float64) @ np.asarray(vec, np.float64), recommend.SCORE_DIGITS) + 0.0
        rows = [(not np.isfinite(s), -s if np.isfinite(s) else 0.0, i) for i, s in zip(ids, scores, strict=True) if i not in seen]
        out += [(user, i, None if bad else -s) for bad, s, i in sorted(rows)[:k]]
    return out


@pytest.mark.parametrize("k", [1, 10, 400])
def test_best_rows_are_exact(k):
    rng = np.random.default_rng(k)
    ids = np.sort(rng.choice(5000, 900, replace=False))
    matrix = rng.normal(size=(900, 6)).astype(np.float32) * rng.lognormal(0, 1.5, (900, 1)).astype(np.float32)
    matrix[100:160] = matrix[100]  # equal scores
    matrix[3], matrix[500, 2] = np.nan, np.inf
    users = []
    for u in range(40):
        vec = rng.normal(size=6) if u else np.zeros(6)
        vec = np.full(6, np.nan) if u == 7 else vec
        users.append((u, vec, set(rng.choice(ids, int(rng.choice([0, 5, 895])), replace=False).tolist())))
    frame = pd.DataFrame({"user_id": [u for u, *_ in users], "vec": [v for _, v, _ in users], "seen": [sorted(s) or None for *_, s in users]})
    found = recommend.best_rows(frame, recommend.Catalog.of(ids, matrix), k)
    got = [(u, i, None if np.isnan(s) else s) for u, i, s in found.itertuples(index=False)]
    want = _plain_best(users, ids, matrix, k)
    assert len(got) == len(want)
    order = {(u, i): n for n, (u, i, _) in enumerate(want)}
    got.sort(key=lambda r: order[r[:2]])
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all((a[2] is None) == (b[2] is None) and (a[2] is None or abs(a[2] - b[2]) < 1e-5) for a, b in zip(got, want, strict=True))


def test_skewed_norms_take_less_than_half_of_the_products():
    rng = np.random.default_rng(3)
    n, users = 20_000, 300
    matrix = (rng.normal(size=(n, 32)) * rng.lognormal(0, 1.0, (n, 1))).astype(np.float32)
    frame = pd.DataFrame({"user_id": range(users), "vec": list(rng.normal(size=(users, 32))), "seen": [None] * users})
    catalog = recommend.Catalog.of(np.arange(n), matrix)
    found = recommend.best_rows(frame, catalog, 10)
    assert len(found) == 10 * users and catalog.products < 0.5 * n * users
    flat = recommend.Catalog.of(np.arange(n), matrix / np.linalg.norm(matrix, axis=1, keepdims=True))
    assert len(recommend.best_rows(frame, flat, 10)) == 10 * users and flat.products <= n * users


def test_no_vector_moves_with_a_candidate_and_keys_may_repeat(spark):
    candidates = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d"), (1, None, "e"), (3, 2, "f")], "user_id int, item long, split string"
    )
    users = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (2, [3.0]), (None, [9.0]), (3, None)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(1, [5.0]), (1, [7.0]), (2, [1.0]), (None, [8.0])], "item long, vec array<double>")
    scored = recommend.score_candidates(candidates, users, items)
    got = sorted((r.split, r.score is None, r.score or 0.0) for r in scored.collect())
    want = [("a", 5.0), ("a", 7.0), ("b", 5.0), ("b", 7.0), ("c", 10.0), ("c", 14.0), ("c", 15.0), ("c", 21.0), ("d", None), ("d", None), ("e", None), ("f", None)]
    assert got == sorted((s, v is None, v or 0.0) for s, v in want)
    assert dict(scored.dtypes)["user_id"] == "int"
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_a_slice_of_users_is_not_held_in_a_task():
    """Users of one slice come batch by batch behind the items, and leave as they come."""
    import pyarrow as pa

    kinds = pa.schema([("_side", pa.int32()), ("user_id", pa.int64()), ("_uv", pa.list_(pa.float64())), ("seen", pa.list_(pa.int64())), ("item", pa.int64()), ("_iv", pa.list_(pa.float32()))])
    items = pa.RecordBatch.from_pylist([{"_side": 0, "item": i, "_iv": [float(i)]} for i in (2, 1, 3)], kinds)
    taken = []

    def batches():
        yield items
        for u in range(50):
            taken.append(u)
            yield pa.RecordBatch.from_pylist([{"_side": 1, "user_id": u, "_uv": [1.0], "seen": [3]}], kinds)

    for n, out in enumerate(recommend._best_of_block(1)(batches())):
        assert len(taken) == n + 1 and out.to_pylist() == [{"user_id": n, "item": 2, "score": 2.0}]
