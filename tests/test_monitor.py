"""Window aggregates against direct counting."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import monitor
from seqloom.streaming import windows as stream_windows


@pytest.fixture(scope="module")
def raw():
    rng = random.Random(11)
    rows = [(i, rng.randrange(0, 900), rng.randrange(4), float(rng.choice([1, 2, 3, 40, 300])), rng.random() < 0.3) for i in range(300)]
    # one busy minute
    return rows + [(1000 + i, 400 + i % 20, 9, float(i % 50), False) for i in range(200)]


@pytest.fixture(scope="module")
def log(spark, raw):
    df = spark.createDataFrame(raw, "event_id int, sec long, user_id int, latency double, is_error boolean")
    return df.select("*", F.timestamp_seconds("sec").alias("ts"), (F.col("latency") / 10).alias("prediction"))


def windows(raw):
    starts = {s - s % 60 - 60 * k for _, s, *_ in raw for k in range(5)}
    return {w: [r for r in raw if w <= r[1] < w + 300] for w in starts}


def test_requests_and_error_rate(log, raw):
    want = windows(raw)
    assert {r.window_start: r.requests for r in monitor.requests_5m(log).collect()} == {w: len(v) for w, v in want.items()}
    got = {r.window_start: r.error_rate for r in monitor.error_rate_5m(log).collect()}
    assert got == {w: pytest.approx(100 * sum(r[4] for r in v) / len(v)) for w, v in want.items()}


@pytest.mark.parametrize("max_rows", [5, None])
def test_exact_percentiles(log, raw, max_rows):
    got = {r.window_start: (r.p50, r.p95, r.p99) for r in monitor.latency_percentiles_5m(log, max_rows=max_rows).collect()}
    for w, rows in windows(raw).items():
        assert got[w] == pytest.approx(tuple(np.percentile([r[3] for r in rows], [50, 95, 99])))


def test_histogram_quantile(spark):
    def estimate(values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "event_id int, latency double").withColumn("ts", F.timestamp_seconds(F.lit(30)))
        return monitor.histogram_quantile_5m(df).where("window_start = 0").first()

    assert estimate([0.5] * 4).p50 == pytest.approx(0.5)
    assert estimate([1000.0] * 4).p50 == 250.0
    mixed = estimate([0.5] * 10 + [7.0] * 10)
    assert mixed.p50 == pytest.approx(1.0) and mixed.p95 == pytest.approx(5 + 5 * 0.9)


def test_rating_counts(spark, log, raw):
    bucket = lambda x: max(1, min(5, round(x / 10)))
    want = {}
    for r in raw:
        want[bucket(r[3])] = want.get(bucket(r[3]), 0) + 1
    assert {r.rating: r.predictions for r in monitor.rating_distribution(log).collect()} == want
    nulls = log.withColumn("prediction", F.lit(None).cast("double"))
    assert monitor.rating_distribution(nulls).count() == 0


def test_batches_gauges_throughput(log, raw):
    rate = {r.window_start: r.requests_per_sec for r in monitor.throughput_1m(log).collect()}
    assert sum(rate.values()) * 60 == pytest.approx(len(raw))
    size = {r.window_start: r.avg_batch_size for r in monitor.avg_batch_size_5m(log).collect()}
    for w, rows in windows(raw).items():
        batches = {(r[2], r[1] // 60) for r in rows}
        assert size[w] == pytest.approx(len(rows) / len(batches))
    last = monitor.latest_gauge(log, "latency", "user_id", ["ts", "event_id"])
    want = {u: max((r for r in raw if r[2] == u), key=lambda r: (r[1], r[0]))[3] for u in {r[2] for r in raw}}
    assert {r.user_id: r.last_value for r in last.collect()} == want


def test_latency_sketches_keep_their_bound(spark, tmp_path):
    rng = random.Random(1)
    rows = [(t, rng.choice([rng.lognormvariate(3, 2), 5.0, None])) for t in (rng.randrange(0, 1200) for _ in range(30_000))]
    log = spark.createDataFrame(rows, "sec long, latency double").withColumn("ts", F.timestamp_seconds("sec"))

    def check(found, error):
        for r in found:
            values = sorted(v for t, v in rows if v is not None and r.window_start <= t < r.window_start + 300)
            assert r.n == len(values)
            for q, p in ((0.5, r.p50), (0.95, r.p95), (0.99, r.p99)):
                assert bisect.bisect_left(values, p) / r.n <= q + error and bisect.bisect_right(values, p) / r.n >= q - error

    found = monitor.latency_sketch_5m(log).collect()
    assert len(found) == 24
    check(found, 3 * monitor.sketch_rank_error())
    small = monitor.latency_sketch_5m(log, size=64).collect()
    check(small, 3 * monitor.sketch_rank_error(64))
    # the stream writes one sketch a minute; a pane that came in two parts counts as a whole
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    log.drop("ts").unionByName(spark.createDataFrame([(9000, 1.0)], "sec long, latency double")).write.parquet(source)
    stream = spark.readStream.schema("sec long, latency double").parquet(source).withColumn("ts", F.timestamp_seconds("sec"))
    stream_windows.start_append(stream_windows.latency_pane_sketches(stream), out, str(tmp_path / "check")).awaitTermination()
    panes = spark.read.parquet(out)
    assert panes.count() == 20
    check(monitor.latency_from_panes(panes).collect(), 3 * monitor.sketch_rank_error())
    halves = monitor.latency_panes(log.where("sec % 2 = 0")).unionByName(monitor.latency_panes(log.where("sec % 2 = 1")))
    check(monitor.latency_from_panes(halves).collect(), 3 * monitor.sketch_rank_error())
    assert monitor.latency_sketch_5m(log.limit(0)).count() == 0
