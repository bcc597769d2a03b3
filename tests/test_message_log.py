"""The message log: offsets, publications that count once, and streams that stop and go on."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from seqloom.sources import message_log as ml

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def messages(spark, n, start=0, topics=("a", "b-c")):
    rows = [(topics[i % len(topics)], f"k{i % 37}", f"v{i}") for i in range(start, start + n)]
    return spark.createDataFrame(rows, "topic string, key string, value string").repartition(3)


def whole(frame):
    """Offsets of every partition run from 0 without gaps or repeats."""
    rows = frame.groupBy("topic", "partition").agg(F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.max("offset").alias("m"))
    return all(r.n == r.d == r.m + 1 for r in rows.collect())


def test_publish_and_read(spark, tmp_path):
    path = str(tmp_path / "log")
    odd = spark.createDataFrame([("a", None, "x"), ("a", "k", None), (None, "k", "lost"), ("a", "", "")], "topic string, key string, value string")
    assert {tuple(r) for r in ml.publish_log(messages(spark, 500), path, partitions=4).collect()} == {("a", 250), ("b-c", 250)}
    assert [tuple(r) for r in ml.publish_log(odd, path, partitions=4).collect()] == [("a", 3)]
    rows = ml.read_log(spark, path)
    assert rows.count() == 503 and whole(rows)
    assert ml.read_log(spark, path, ["b-c"]).count() == 250
    assert rows.where("key is null").first().partition == 0
    # one key, one partition; a later publication comes after an earlier one
    assert rows.groupBy("topic", "key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    ml.publish_log(messages(spark, 500, 500), path, partitions=4)
    late = F.substring("value", 2, 9).try_cast("int") >= 500
    order = ml.read_log(spark, path, ["b-c"]).groupBy("partition").agg(F.min(F.when(late, F.col("offset"))).alias("l"), F.max(F.when(~late, F.col("offset"))).alias("e"))
    assert order.where("l < e").count() == 0


def test_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    assert ml.read_log(spark, path).count() == 0
    assert ml.publish_log(messages(spark, 3).limit(0), path).count() == 0
    assert ml.read_log(spark, path).count() == 0


def test_stream_stops_in_the_middle_and_goes_on(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    ml.publish_log(messages(spark, 2000), path, partitions=3)
    sizes = {}

    def write(fail_at=None):
        def batch(df, i):
            df.write.mode("overwrite").parquet(f"{out}/batch={i}")
            if i == fail_at:
                raise RuntimeError("lost")
            sizes[i] = {r.topic: r["count"] for r in spark.read.parquet(f"{out}/batch={i}").groupBy("topic").count().collect()}

        return batch

    def go(fail_at=None):
        stream = ml.stream_log(spark, path, group="g", max_rows=300)
        q = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write(fail_at)).start()
        try:
            ml.catch_up(q, path)
        finally:
            q.stop()

    with pytest.raises(StreamingQueryException):
        go(fail_at=2)
    assert set(sizes) == {0, 1}
    go()
    ml.publish_log(messages(spark, 700, 2000), path, partitions=3)
    go()
    rows = spark.read.parquet(out)
    assert rows.count() == 2700 and rows.select("value").distinct().count() == 2700 and whole(rows)
    assert max(n for s in sizes.values() for n in s.values()) <= 600 and len(sizes) >= 5
    assert sorted(sizes) == list(range(len(sizes)))


def test_no_limit_takes_all_at_once(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    for start in (0, 400):
        ml.publish_log(messages(spark, 400, start), path)
        stream = ml.stream_log(spark, path, ["a"])
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == (start + 400) // 2
    with pytest.raises(Exception, match="needs a group"):
        ml.stream_log(spark, path, max_rows=5).writeStream.format("noop").option("checkpointLocation", checkpoint + "2").start().processAllAvailable()


def test_stream_publication_counts_once(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    for k in range(3):
        messages(spark, 100, 100 * k).write.mode("append").parquet(source)
        stream = spark.readStream.schema("topic string, key string, value string").parquet(source)
        ml.start_publishing(stream, path, checkpoint, "w").awaitTermination()
        rows = ml.read_log(spark, path)
        assert rows.count() == 100 * (k + 1) and whole(rows)
    # the driver dies after the entry is written and before Spark notes the batch: it is run again
    commits = tmp_path / "check" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink()
    stream = spark.readStream.schema("topic string, key string, value string").parquet(source)
    ml.start_publishing(stream, path, checkpoint, "w").awaitTermination()
    rows = ml.read_log(spark, path)
    assert rows.count() == 300 and rows.select("value").distinct().count() == 300
    files = {f.name for f in (tmp_path / "log" / "data").iterdir() if f.suffix == ".parquet"}
    named = {s[2].rpartition("/")[2] for e in ml.Log(path).entries() for s in e["segments"]}
    assert files == named  # those of the second run are gone


JOB = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from seqloom import build_session
from seqloom.sources import message_log as ml
spark = build_session("log", "local[2,3]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
rows = spark.range(0, 4000, 1, 4).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
def shaky(batches):
    for i, b in enumerate(batches):
        yield b
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost executor")
spark.dataSource.register(ml.MessageLog)
kept = ml._keyed(rows, 3).repartition(3, "partition").mapInArrow(shaky, "topic string, partition int, key string, value string")
kept.write.format(ml.FORMAT).mode("append").options(path={path!r}, writer="w").save()
r = ml.read_log(spark, {path!r})
print("RESULT", r.count(), r.select("key").distinct().count(), r.select("partition", "offset").distinct().count())
def dead(batches):
    yield from batches
    raise RuntimeError("lost for good")
try:
    ml._keyed(rows, 3).repartition(3, "partition").mapInArrow(dead, "topic string, partition int, key string, value string").write.format(ml.FORMAT).mode("append").options(path={path!r}, writer="x").save()
except Exception:
    print("AFTER", ml.read_log(spark, {path!r}).count())
"""


def test_lost_tasks_publish_nothing_twice(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(JOB.format(root=ROOT, path=str(tmp_path / "log")))
    done = subprocess.run([sys.executable, str(job)], cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False)
    assert "RESULT 4000 4000 4000" in done.stdout and "AFTER 4000" in done.stdout, done.stderr[-3000:]
    entries = sorted((tmp_path / "log" / "log").glob("*.json"))
    assert len(entries) == 1 and sum(s[4] for s in json.loads(entries[0].read_text())["segments"]) == 4000
