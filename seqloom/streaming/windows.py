"""Monitoring windows on a stream, with a watermark for late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqloom.functions.encode import rating_bucket
from seqloom.operators.monitor import SKETCH_SIZE


def windowed(
    log: DataFrame, measures: list[Column], *, width: str, slide: str | None = None, by: list[str] | None = None, late: str = "10 minutes"
) -> DataFrame:
    """Aggregates per event-time window; rows later than ``late`` behind the newest event are dropped."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    agg = log.withWatermark("ts", late).groupBy(window, *(by or [])).agg(*measures)
    return agg.select(
        F.unix_seconds("window.start").alias("window_start"), *[c for c in agg.columns if c != "window"]
    )


def request_windows(log: DataFrame, *, width: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Requests, errors and error rate per window."""
    sums = windowed(
        log,
        [F.count(F.lit(1)).alias("requests"), F.count_if("is_error").alias("errors")],
        width=width,
        slide=slide,
        late=late,
    )
    return sums.withColumn("error_rate", 100.0 * F.col("errors") / F.greatest(F.col("requests"), F.lit(1)))


def rating_windows(log: DataFrame, *, width: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """Predictions per rating bucket and window."""
    rated = log.withColumn("rating", rating_bucket(F.col("prediction"))).where("rating IS NOT NULL")
    return windowed(rated, [F.count(F.lit(1)).alias("predictions")], width=width, by=["rating"], late=late)


def throughput_windows(log: DataFrame, *, late: str = "10 minutes") -> DataFrame:
    """Requests and errors per second, minute by minute."""
    sums = windowed(
        log, [F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("e")], width="1 minute", late=late
    )
    per_second = [(F.col("n") / 60.0).alias("requests_per_sec"), (F.col("e") / 60.0).alias("errors_per_sec")]
    return sums.select("window_start", *per_second)


def rating_rate_windows(log: DataFrame, *, width: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Predictions per second and rating bucket in sliding windows of ``width``."""
    rated = log.withColumn("rating", rating_bucket(F.col("prediction"))).where("rating IS NOT NULL")
    window = F.window("ts", width, slide)
    agg = rated.withWatermark("ts", late).groupBy(window, "rating").agg(F.count(F.lit(1)).alias("n"))
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    return agg.select(
        F.unix_seconds("window.start").alias("window_start"), "rating", (F.col("n") / seconds).alias("rate")
    )


def batch_size_windows(log: DataFrame, *, width: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Mean batch size in sliding windows, where a user's requests of one minute are a batch.

    Two aggregations follow each other: the minutes that the first one closes are the rows of the second.
    """
    minutes = (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 minute"), "user_id")
        .agg(F.count(F.lit(1)).alias("batch_size"))
    )
    window = F.window(F.window_time("window"), width, slide)
    agg = minutes.groupBy(window).agg(F.sum("batch_size").alias("requests"), F.count(F.lit(1)).alias("batches"))
    return agg.select(
        F.unix_seconds("window.start").alias("window_start"),
        (F.col("requests") / F.greatest(F.col("batches"), F.lit(1))).alias("avg_batch_size"),
    )


def latency_windows(log: DataFrame, *, width: str = "5 minutes", late: str = "10 minutes", accuracy: int = 10_000) -> DataFrame:
    """Approximate latency percentiles per window; a stream cannot keep every value."""
    quantiles = F.percentile_approx("latency", [0.5, 0.95, 0.99], accuracy).alias("q")
    rows = windowed(log, [quantiles], width=width, late=late)
    return rows.select("window_start", *[F.get("q", F.lit(i)).alias(p) for i, p in enumerate(["p50", "p95", "p99"])])


def start_append(windows: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Write windows once they are closed."""
    return (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latency_pane_sketches(log: DataFrame, *, late: str = "10 minutes", size: int = SKETCH_SIZE) -> DataFrame:
    """``(pane, sketch)`` of closed minutes: the state is one sketch per open minute, however many windows a minute is in.

    ``monitor.latency_from_panes`` makes sliding windows of what the stream has written.
    """
    known = log.where("latency IS NOT NULL").withWatermark("ts", late)
    sketch = F.kll_sketch_agg_double(F.col("latency").cast("double"), F.lit(size)).alias("sketch")
    return known.groupBy(F.window("ts", "1 minute")).agg(sketch).select(F.unix_seconds("window.start").alias("pane"), "sketch")
