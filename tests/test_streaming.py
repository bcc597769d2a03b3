"""Streams: whole results, restarts, late and broken rows."""

import json

import pytest
from pyspark.sql import functions as F

from seqloom.sources.schemas import raw_table_schema
from seqloom.streaming import ingest, online, windows

TOPICS = ["raw-events", "new-user", "new-movie", "new-rating"]


def message(topic, body):
    return (topic, "k", body if isinstance(body, str) else json.dumps(body))


def write(spark, rows, path, name):
    spark.createDataFrame(rows, ingest.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_ingest_restart_and_quarantine(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "check"))
    hooked = []

    def go():
        stream = ingest.read_message_files(spark, source, max_files=1)
        hook = lambda df, i: hooked.append(df.count())
        ingest.start_ingest(stream, root, checkpoint, TOPICS, hook=hook).awaitTermination()

    user = {"timestamp": "2026-01-02T03:04:05", "user_id": 7, "gender": "F", "age": 25, "occupation": 1, "zip_code": "x"}
    write(spark, [message("new-user", user), message("new-user", '{"user_id": 8, "ti'), message("other", {"id": "1"})], source, "a")
    go()
    rating = {"timestamp": "2026-01-03T00:00:00Z", "user_id": 7, "movie_id": 3, "rating": 4, "rating_timestamp": 5}
    write(spark, [message("new-rating", rating), message("new-rating", {**rating, "movie_id": None})], source, "b")
    write(spark, [message("raw-events", {"id": "e", "timestamp": "2026-02-01T00:00:00", "payload": {"x": 1.0}})], source, "c")
    go()
    go()

    users = spark.read.schema(raw_table_schema("new-user")).parquet(f"{root}/new_user").collect()
    assert [(u.user_id, u.year, u.month, u.day, u.zip_code) for u in users] == [(7, "2026", "01", "02", "x")]
    ratings = spark.read.schema(raw_table_schema("new-rating")).parquet(f"{root}/new_rating").collect()
    assert [(r.movie_id, r.month, r.day) for r in ratings] == [(3, "01", "03")]
    events = spark.read.schema(raw_table_schema("raw-events")).parquet(f"{root}/raw_events").collect()
    assert [(e.id, e.payload) for e in events] == [("e", {"x": "1.0"})]
    rejected = spark.read.schema(ingest.MESSAGE_SCHEMA).parquet(f"{root}/quarantine").collect()
    assert sorted(r.topic for r in rejected) == ["new-rating", "new-user", "other"]
    assert sum(hooked) == 6


def test_envelope_and_time_rules_on_the_stream(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "check"))
    whole = {"id": "1", "timestamp": "2026-02-01T00:00:00", "payload": {"x": 1}}
    user = {"user_id": 5, "timestamp": "2026-02-01T00:00:00"}
    rows = [message("raw-events", {k: v for k, v in whole.items() if k != left}) for left in ("id", "timestamp", "payload", "")]
    rows += [message("raw-events", {**whole, "timestamp": "zz"}), message("new-user", {**user, "timestamp": "zz"})]
    rows += [message("new-user", {"user_id": 6, "event_timestamp": "2020-05-06T07:08:09"}), message("new-user", user)]
    rows += [message("new-user", {**user, "event_timestamp": "never"})]
    write(spark, rows, source, "a")
    ingest.start_ingest(ingest.read_message_files(spark, source), root, checkpoint, TOPICS).awaitTermination()
    rejected = spark.read.schema(ingest.MESSAGE_SCHEMA + ", reason string").parquet(f"{root}/quarantine").collect()
    assert sorted(r.reason for r in rejected) == ["incomplete"] * 3 + ["unreadable time"] * 3
    users = spark.read.schema(raw_table_schema("new-user")).parquet(f"{root}/new_user").collect()
    assert {(u.user_id, u.year, u.month, u.day) for u in users} == {(5, "2026", "02", "01"), (6, "2020", "05", "06")}
    assert (tmp_path / "raw" / "new_user" / "year=2020" / "month=05" / "day=06" / "batch=0").is_dir()
    assert spark.read.schema(raw_table_schema("raw-events")).parquet(f"{root}/raw_events").count() == 1


def test_single_table_file_sink(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "check"))
    rows = [message("new-rating", {"user_id": 1, "movie_id": i, "rating": 3, "rating_timestamp": i}) for i in range(5)]
    write(spark, rows, source, "a")
    for _ in range(2):
        ingest.start_single_table(ingest.read_message_files(spark, source), "new-rating", path, checkpoint).awaitTermination()
    table = spark.read.schema(raw_table_schema("new-rating")).parquet(path)
    # no time in the message: the time of processing decides the partition
    assert table.count() == 5 and table.where("event_timestamp IS NULL").count() == 0


@pytest.mark.parametrize("slide", [None, "1 minute"])
def test_closed_windows_and_late_rows(spark, tmp_path, slide):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "sec long, is_error boolean, latency double, prediction double"

    def put(seconds):
        rows = [(s, s % 2 == 0, float(s), 3.0) for s in seconds]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def go():
        log = spark.readStream.schema(schema).parquet(source).withColumn("ts", F.timestamp_seconds("sec"))
        windows.start_append(windows.request_windows(log, slide=slide), out, checkpoint).awaitTermination()

    put([10, 20, 310, 2000])
    go()
    put([15, 2001])  # 15 is late: its window was closed
    go()
    put([9000])
    go()
    got = {r.window_start: (r.requests, r.errors) for r in spark.read.parquet(out).collect()}
    assert got[0] == (2, 2) and got[300] == (1, 1)
    assert got[1800] == (2, 1)
    if slide is None:
        assert set(got) == {0, 300, 1800}


def test_rating_and_latency_windows_run(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(s, float(s % 7), float(s % 9)) for s in range(0, 4000, 10)]
    spark.createDataFrame(rows, "sec long, prediction double, latency double").write.parquet(source)
    log = spark.readStream.schema("sec long, prediction double, latency double").parquet(source)
    log = log.withColumn("ts", F.timestamp_seconds("sec"))
    for name, agg in (("r", windows.rating_windows(log)), ("l", windows.latency_windows(log))):
        windows.start_append(agg, str(tmp_path / name), str(tmp_path / f"{name}-check")).awaitTermination()
    batch = {(w * 900, b): 0 for w in range(3) for b in range(1, 6)}
    for s, p, _ in rows:
        key = (s - s % 900, max(1, min(5, round(p))))
        if key in batch:
            batch[key] += 1
    got = {(r.window_start, r.rating): r.predictions for r in spark.read.parquet(str(tmp_path / "r")).collect()}
    assert got == {k: v for k, v in batch.items() if v}
    assert spark.read.parquet(str(tmp_path / "l")).where("p50 <= p95 AND p95 <= p99").count() == 11


def test_online_upsert_replay_and_compaction(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "online", "check"))
    schema = "user_id int, t int, v string"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        online.start_online_upsert(stream, path, checkpoint, ["user_id"], ["t"]).awaitTermination()
        current = online.read_online(spark, path, spark.createDataFrame([], schema).schema, ["user_id"], ["t"])
        return {tuple(r) for r in current.collect()}

    assert put([(1, 1, "a"), (1, 3, "b"), (2, 5, "c")]) == {(1, 3, "b"), (2, 5, "c")}
    assert put([(1, 2, "old"), (2, 6, "d"), (3, 1, "e")]) == {(1, 3, "b"), (2, 6, "d"), (3, 1, "e")}
    schema_ = spark.createDataFrame([], schema).schema
    online.compact_online(spark, path, schema_, ["user_id"], ["t"])
    assert len(online._current(spark, path)[0]) == 1
    # the stream goes on after the snapshot, and a second one replaces the first
    assert put([(3, 9, "f"), (1, 0, "old")]) == {(1, 3, "b"), (2, 6, "d"), (3, 9, "f")}
    online.compact_online(spark, path, schema_, ["user_id"], ["t"])
    online.expire_online(spark, path)
    assert [p.name for p in (tmp_path / "online" / "snapshots").iterdir()] == ["upto=000000002"]
    assert not list((tmp_path / "online" / "batches").iterdir())
    again = online.read_online(spark, path, schema_, ["user_id"], ["t"])
    assert {tuple(r) for r in again.collect()} == {(1, 3, "b"), (2, 6, "d"), (3, 9, "f")}
