"""From delimited files through the ingest stream to staged tables, samples, model and predictions."""

import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import classify, contract, features
from seqloom.operators.features import FeatureView
from seqloom.plans import jobs
from seqloom.sources import delimited, events
from seqloom.streaming import ingest

VIEW = FeatureView("raw_event_features", "user_id", "event_timestamp", ["gender_idx", "age_idx", "occupation", "target_time"], tie=["target"])


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    rng = random.Random(5)
    genres = ["Action", "Drama", "War", "Unknown kind"]
    ratings = {(u, m): (rng.randrange(1, 6), 978300000 + rng.randrange(10**6)) for u in range(1, 21) for m in rng.sample(range(1, 41), 3 + u)}
    (root / "users.dat").write_text("".join(f"{u}::{'FM'[u % 2]}::{(1, 18, 25)[u % 3]}::{u % 21}::z{u}\n" for u in range(1, 21)) + "bad::line\n")
    (root / "movies.dat").write_text("".join(f"{m}::Title {m}::{'|'.join(rng.sample(genres, 2))}\n" for m in range(1, 41)))
    (root / "ratings.dat").write_text("".join(f"{u}::{m}::{r}::{t}\n" for (u, m), (r, t) in ratings.items()))

    now = F.lit("2026-01-01T00:00:00").alias("timestamp")
    for name, parse, topic in (
        ("users", delimited.parse_users, "new-user"),
        ("movies", delimited.parse_movies, "new-movie"),
        ("ratings", delimited.parse_ratings, "new-rating"),
    ):
        rows = parse(delimited.read_lines(spark, str(root / f"{name}.dat"))).withColumn("timestamp", now)
        key = [c for c in ("user_id", "movie_id") if c in rows.columns]
        events.publish(events.encode_events(rows, key, topic, rows.columns), path=str(root / "topics"))
    stream = ingest.read_message_files(spark, str(root / "topics"))
    ingest.start_ingest(stream, str(root / "raw"), str(root / "check"), list(ingest.TOPIC_SCHEMAS)).awaitTermination()
    return root, ratings


def test_staged_features(spark, world):
    root, ratings = world
    out = str(root / "features")
    jobs.stage_features(spark, str(root / "raw"), out)
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("user_features").count() == 20
    movies = read("movie_features")
    assert movies.where("internal_movie_id = movie_id").count() == 40
    assert read("rating_events").count() == sum(r >= 3 for r, _ in ratings.values())
    meta = spark.read.json(f"{out}/metadata").first()
    assert (meta.num_items, meta.num_users, meta.num_genres, meta.num_occupations) == (41, 20, 19, 21)
    assert spark.read.json(f"{out}/id_map").count() == 80 and spark.read.json(f"{out}/movies").count() == 40


def test_splits_model_and_predictions(spark, world):
    root, ratings = world
    out = str(root / "splits")
    jobs.build_split_tables(spark, str(root / "raw"), out)
    positive = {}
    for (u, m), (r, t) in ratings.items():
        if r >= 3:
            positive.setdefault(u, []).append((t, m))
    index = {m: i for i, m in enumerate(sorted({m for rows in positive.values() for _, m in rows}), 1)}
    long = {u: [index[m] for _, m in sorted(rows)] for u, rows in positive.items() if len(rows) >= 5}
    test = {r.user_id: (list(r.item_seq), r.target) for r in jobs.read_split(spark, out, "test").collect()}
    assert test == {u: (items[:-1][-50:], items[-1]) for u, items in long.items()}
    train = jobs.read_split(spark, out, "train")
    assert train.count() == sum(len(items) - 3 for items in long.values())

    staged_root = str(root / "staged")
    jobs.stage_samples(spark, out, staged_root, VIEW, "2001-01-14 00:00:00")
    staged = spark.read.parquet(f"{staged_root}/staged")
    assert contract.same_columns(staged) and staged.count() == train.count()
    assert contract.contract_violations(staged).agg(F.sum("violations")).first()[0] == 0
    online = spark.read.parquet(f"{staged_root}/online")
    assert 0 < online.count() <= len(long)

    model, scored = classify.train_classifier(staged, "random_forest", {"numTrees": 3, "seed": 1}, key=["user_id", "event_timestamp"])
    assert 0 <= classify.accuracy(scored).first().accuracy <= 1
    requests = spark.createDataFrame([(1,), (20,), (777,)], "user_id long")
    resolved = features.online_lookup_with_fallback(requests, online, staged, ["event_timestamp", "target"])
    assert classify.batch_predict(resolved, model).count() == 3


def test_empty_raw_table_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows in users"):
        jobs.stage_features(spark, str(tmp_path), str(tmp_path / "out"))
