"""The online table in hash buckets."""

import re
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from seqloom.sources import versions
from seqloom.streaming import buckets

SCHEMA = "user_id long, t int, v string"


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def put(spark, items, root, **more):
    return buckets.upsert(rows(spark, items), root, ["user_id"], ["t"], buckets=8, **more)


def content(spark, root):
    return {tuple(r) for r in buckets.read(spark, root).collect()}


def test_newest_rows_win_and_only_touched_buckets_change(spark, tmp_path):
    root = str(tmp_path / "t")
    assert put(spark, [(i, 1, "a") for i in range(100)], root) == 8
    before = set(versions.current(spark, root).files)
    assert put(spark, [(3, 2, "b"), (3, 0, "late"), (500, 1, "new"), (None, 4, "null")], root) <= 3
    after = set(versions.current(spark, root).files)
    assert len(before & after) >= 5 and len(after) == 8
    put(spark, [(3, 1, "later still"), (None, 5, "null too")], root)
    want = {(i, 1, "a") for i in range(100)} - {(3, 1, "a")} | {(3, 2, "b"), (500, 1, "new"), (None, 5, "null too")}
    assert content(spark, root) == want
    # other bucket counts do not matter once the table is there, compaction changes nothing
    assert buckets.upsert(rows(spark, [(7, 9, "z")]), root, ["user_id"], ["t"], buckets=3) == 1
    versions.compact(spark, root)
    assert content(spark, root) == want - {(7, 1, "a")} | {(7, 9, "z")}
    with pytest.raises(ValueError, match="columns differ"):
        buckets.upsert(spark.createDataFrame([(1, 1)], "user_id long, t int"), root, ["user_id"], ["t"])
    assert put(spark, [], root) == 0 and len(content(spark, root)) == 102


def test_lookup_opens_the_buckets_it_needs(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, [(i, 1, f"v{i}") for i in range(2000)], root)
    requests = spark.createDataFrame([(5,), (17,), (9999,), (None,)], "user_id long")
    found = buckets.rows_of(requests, root, ["user_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(found.inputFiles()) <= 4 and re.search(r"PushedFilters: \[In\(user_id, \[[0-9,]{9}\]\)\]", plan)
    assert sorted((r.user_id, r.v) for r in found.collect()) == [(5, "v5"), (17, "v17")]
    many = spark.range(1500).withColumnRenamed("id", "user_id")
    assert buckets.rows_of(many, root, ["user_id"]).join(many, "user_id").count() == 1500
    assert buckets.rows_of(requests.limit(0), root, ["user_id"]).count() == 0
    file = next((tmp_path / "t" / "data").rglob("*.parquet"))
    keys = pq.read_table(file, partitioning=None)["user_id"].to_pylist()
    assert keys == sorted(keys)


def test_stream_counts_once(spark, tmp_path):
    root, source, checkpoint = (str(tmp_path / n) for n in ("t", "in", "check"))

    def go(fail_at=None):
        def batch(df, i):
            buckets.upsert(df, root, ["user_id"], ["t"], buckets=4, writer="w", batch=i)
            if i == fail_at:
                raise RuntimeError("lost after the commit")

        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()

    for k in range(3):
        rows(spark, [(i, k, f"{k}") for i in range(k, 20)]).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(StreamingQueryException):
        go(fail_at=1)
    go()
    assert content(spark, root) == {(i, min(i, 2), f"{min(i, 2)}") for i in range(20)}
    assert versions.current(spark, root).batches == {"w": 2} and versions.current(spark, root).number == 2


def test_writers_beside_each_other(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, [(0, 0, "")], root)
    threads = [threading.Thread(target=put, args=(spark, [(i, k, f"{k}") for i in range(40)], root)) for k in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert content(spark, root) == {(i, 4, "4") for i in range(40)}


def test_keys_of_two_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = spark.range(60).select((F.col("id") % 6).alias("a"), (F.col("id") % 5).cast("string").alias("b"), F.col("id").alias("t"))
    buckets.upsert(frame, root, ["a", "b"], ["t"], buckets=4)
    want = {(r.a, r.b): r.t for r in frame.orderBy("t").collect()}
    assert {(r.a, r.b): r.t for r in buckets.read(spark, root).collect()} == want
    asked = spark.createDataFrame([(1, "1")], "a long, b string")
    assert len(buckets.rows_of(asked, root, ["a", "b"]).inputFiles()) == 1
