"""Prediction-log windows, batch and streaming, and the streaming ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import monitor
from seqloom.plans.bindings import VIEW_VALUE, Tables
from seqloom.plans.registry import query
from seqloom.session import scratch_path
from seqloom.sources import message_log
from seqloom.sources.schemas import raw_table_schema
from seqloom.streaming import buckets, ingest, online, stateful, windows

_PLACED = """placed AS (SELECT *, CAST(sec - sec % 60 - 60 * k AS BIGINT) AS window_start FROM log, (SELECT unnest(range(5)) AS k))"""


@query(f"WITH {_PLACED} SELECT window_start, count(*) AS requests FROM placed GROUP BY window_start", "log")
def requests_5m(t: Tables) -> DataFrame:
    return monitor.requests_5m(t.log)


@query(f"WITH {_PLACED} SELECT window_start, count(*) FILTER (WHERE is_error) AS errors FROM placed GROUP BY window_start", "log")
def errors_5m(t: Tables) -> DataFrame:
    return monitor.errors_5m(t.log)


@query(
    f"""WITH {_PLACED} SELECT window_start, 100.0::DOUBLE * count(*) FILTER (WHERE is_error) / greatest(count(*), 1) AS error_rate
    FROM placed GROUP BY window_start""",
    "log",
)
def error_rate_5m(t: Tables) -> DataFrame:
    return monitor.error_rate_5m(t.log)


@query(
    """WITH batches AS (SELECT user_id, sec - sec % 60 AS minute, count(*) AS size FROM log GROUP BY ALL),
    placed AS (SELECT size, CAST(minute - 60 * k AS BIGINT) AS window_start FROM batches, (SELECT unnest(range(5)) AS k))
    SELECT window_start, CAST(sum(size) AS DOUBLE) / greatest(count(*), 1) AS avg_batch_size FROM placed GROUP BY window_start""",
    "log",
)
def avg_batch_size_5m(t: Tables) -> DataFrame:
    return monitor.avg_batch_size_5m(t.log)


@query(
    """SELECT CAST(sec - sec % 60 AS BIGINT) AS window_start, count(*) / 60.0::DOUBLE AS requests_per_sec,
    count(*) FILTER (WHERE is_error) / 60.0::DOUBLE AS errors_per_sec FROM log GROUP BY 1""",
    "log",
)
def throughput_1m(t: Tables) -> DataFrame:
    return monitor.throughput_1m(t.log)


@query(
    f"""WITH {_PLACED} SELECT window_start, round(quantile_cont(latency, 0.5), 6) AS p50, round(quantile_cont(latency, 0.95), 6) AS p95,
    round(quantile_cont(latency, 0.99), 6) AS p99 FROM placed GROUP BY window_start""",
    "log",
)
def latency_percentiles_5m(t: Tables) -> DataFrame:
    rows = monitor.latency_percentiles_5m(t.log)
    return rows.select("window_start", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


_WITHIN = ", ".join(f"true AS p{round(q * 100)}_within" for q in monitor.QUANTILES)


def _sketch_errors(t: Tables, sketched: DataFrame) -> DataFrame:
    """Whether the exact ranks of sketched percentiles are within three times the error that 99 of 100 keep."""
    minute = monitor.pane_start(F.col("ts"))
    placed = t.log.select(F.explode(F.sequence(minute - 240, minute, F.lit(60))).alias("window_start"), "latency")
    judged, error = [], 3 * monitor.sketch_rank_error()
    for q in monitor.QUANTILES:
        name = f"p{round(q * 100)}"
        below = F.count_if(F.col("latency") < F.col(name)) / F.col("n")
        upto = F.count_if(F.col("latency") <= F.col(name)) / F.col("n")
        judged.append(((below <= q + error) & (upto >= q - error)).alias(f"{name}_within"))
    return placed.join(sketched, "window_start").groupBy("window_start", "n").agg(*judged)


@query(f"WITH {_PLACED} SELECT window_start, count(latency) AS n, {_WITHIN} FROM placed GROUP BY window_start HAVING count(latency) > 0", "log")
def latency_sketch_5m(t: Tables) -> DataFrame:
    """Percentiles from mergeable sketches of minutes, judged by their exact ranks."""
    return _sketch_errors(t, monitor.latency_sketch_5m(t.log))


def _bucket_quantile(q: float) -> str:
    bounds = monitor.LATENCY_BOUNDS
    cases = []
    for i, b in enumerate(bounds):
        low, below = (bounds[i - 1], f"b{i - 1}") if i else (0.0, "0")
        cases.append(f"WHEN b{i} >= {q} * n THEN {low} + ({b} - {low}) * ({q} * n - {below}) / (b{i} - {below})")
    return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]} END, 6) AS p{round(q * 100)}"


_BUCKETS = ", ".join(
    f"CAST(count(*) FILTER (WHERE latency <= {b}) AS DOUBLE) AS b{i}" for i, b in enumerate(monitor.LATENCY_BOUNDS)
)


@query(
    f"""WITH {_PLACED}, h AS (SELECT window_start, CAST(count(*) AS DOUBLE) AS n, {_BUCKETS} FROM placed GROUP BY window_start)
    SELECT window_start, {', '.join(_bucket_quantile(q) for q in monitor.QUANTILES)} FROM h""",
    "log",
)
def histogram_quantile_5m(t: Tables) -> DataFrame:
    rows = monitor.histogram_quantile_5m(t.log)
    return rows.select("window_start", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


_RATED = """rated AS (SELECT *, CAST(greatest(1, least(5, round_even(prediction, 0))) AS INTEGER) AS rating FROM log WHERE prediction IS NOT NULL)"""


@query(f"WITH {_RATED} SELECT rating, count(*) AS predictions FROM rated GROUP BY rating", "log")
def rating_bucket(t: Tables) -> DataFrame:
    return monitor.rating_distribution(t.log)


@query(
    f"WITH {_RATED} SELECT CAST(sec - sec % 900 AS BIGINT) AS window_start, rating, count(*) AS predictions FROM rated GROUP BY ALL",
    "log",
)
def rating_distribution_15m(t: Tables) -> DataFrame:
    return monitor.rating_distribution_15m(t.log)


@query(
    f"""WITH {_RATED}, placed AS (SELECT rating, CAST(sec - sec % 60 - 60 * k AS BIGINT) AS window_start FROM rated, (SELECT unnest(range(5)) AS k))
    SELECT window_start, rating, count(*) / 300.0::DOUBLE AS rate FROM placed GROUP BY ALL""",
    "log",
)
def rating_rate_5m(t: Tables) -> DataFrame:
    return monitor.rating_rate_5m(t.log)


@query("SELECT label, arg_max(latency, (ts, event_id)) AS last_value FROM log GROUP BY label", "log")
def latest_gauge(t: Tables) -> DataFrame:
    return monitor.latest_gauge(t.log, "latency", "label", ["ts", "event_id"])


def _event_stream(t: Tables) -> DataFrame:
    """The event table as a file stream."""
    schema = t.read("events").schema
    files = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.root)
    return files.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    """WITH w AS (SELECT CAST(sec - sec % 300 AS BIGINT) AS window_start, count(*) AS requests,
        count(*) FILTER (WHERE is_error) AS errors FROM log GROUP BY 1)
    SELECT window_start, requests, errors, 100.0::DOUBLE * errors / greatest(requests, 1) AS error_rate FROM w
    WHERE window_start + 300 <= (SELECT floor(epoch(max(ts) - INTERVAL 10 MINUTE) * 1000) / 1000 FROM log)""",
    "log",
)
def stream_windows(t: Tables) -> DataFrame:
    """Request windows as a stream closes them: all but those the watermark has not passed."""
    stream = _event_stream(t).select("ts", (F.col("event_type") == "error").alias("is_error"))
    out = scratch_path(t.spark, "stream-windows")
    agg = windows.request_windows(stream)
    windows.start_append(agg, out, scratch_path(t.spark, "stream-windows-checkpoint")).awaitTermination()
    return t.spark.read.schema(agg.schema).parquet(out)


def _closed(t: Tables, agg: DataFrame, label: str) -> DataFrame:
    """The windows of ``agg`` that a stream over the events closes."""
    out = scratch_path(t.spark, label)
    windows.start_append(agg, out, scratch_path(t.spark, f"{label}-checkpoint")).awaitTermination()
    return t.spark.read.schema(agg.schema).parquet(out)


def _log_stream(t: Tables) -> DataFrame:
    return _event_stream(t).select(
        "ts", "user_id", (F.col("value") / 100).alias("prediction"), (F.col("event_type") == "error").alias("is_error")
    )


_CLOSED = "<= (SELECT floor(epoch(max(ts) - INTERVAL 10 MINUTE) * 1000) / 1000 FROM log)"


@query(
    f"""WITH w AS (SELECT CAST(sec - sec % 60 - 60 * k AS BIGINT) AS window_start, count(*) AS requests,
        count(*) FILTER (WHERE is_error) AS errors FROM log, (SELECT unnest(range(5)) AS k) GROUP BY 1)
    SELECT window_start, requests, errors, 100.0::DOUBLE * errors / greatest(requests, 1) AS error_rate FROM w
    WHERE window_start + 300 {_CLOSED}""",
    "log",
)
def stream_windows_sliding(t: Tables) -> DataFrame:
    """Five-minute request windows that slide by a minute, as a stream closes them."""
    return _closed(t, windows.request_windows(_log_stream(t), slide="1 minute"), "stream-sliding")


@query(
    f"""WITH w AS (SELECT CAST(sec - sec % 60 AS BIGINT) AS window_start, count(*) AS n, count(*) FILTER (WHERE is_error) AS e
        FROM log GROUP BY 1)
    SELECT window_start, n / 60.0::DOUBLE AS requests_per_sec, e / 60.0::DOUBLE AS errors_per_sec FROM w WHERE window_start + 60 {_CLOSED}""",
    "log",
)
def stream_throughput(t: Tables) -> DataFrame:
    return _closed(t, windows.throughput_windows(_log_stream(t)), "stream-throughput")


@query(
    f"""WITH {_RATED}, w AS (SELECT CAST(sec - sec % 60 - 60 * k AS BIGINT) AS window_start, rating, count(*) AS n
        FROM rated, (SELECT unnest(range(5)) AS k) GROUP BY 1, 2)
    SELECT window_start, rating, n / 300.0::DOUBLE AS rate FROM w WHERE window_start + 300 {_CLOSED}""",
    "log",
)
def stream_rating_rate(t: Tables) -> DataFrame:
    return _closed(t, windows.rating_rate_windows(_log_stream(t)), "stream-ratings")


@query(
    f"""WITH b AS (SELECT user_id, sec - sec % 60 AS minute, count(*) AS batch_size FROM log GROUP BY 1, 2),
    w AS (SELECT CAST(minute - 60 * k AS BIGINT) AS window_start, sum(batch_size) / CAST(count(*) AS DOUBLE) AS avg_batch_size
        FROM b, (SELECT unnest(range(5)) AS k) GROUP BY 1)
    SELECT * FROM w WHERE window_start + 300 {_CLOSED}""",
    "log",
)
def stream_batch_size(t: Tables) -> DataFrame:
    return _closed(t, windows.batch_size_windows(_log_stream(t)), "stream-batches")


INGEST_SQL = """WITH m AS (SELECT CASE event_id % 4 WHEN 0 THEN 'raw_events' WHEN 1 THEN 'new_user' WHEN 2 THEN 'new_movie' ELSE 'new_rating' END AS name,
        CASE WHEN event_id % 97 = 0 THEN 'incomplete' WHEN event_id % 83 = 0 THEN 'unreadable time'
             WHEN event_id % 89 = 0 AND event_id % 4 = 0 THEN 'incomplete' ELSE '' END AS reason,
        CASE WHEN event_id % 89 = 0 THEN ts - INTERVAL 1 DAY ELSE ts END AS ts FROM events)
    SELECT CASE WHEN reason <> '' THEN 'quarantine' ELSE name END AS table_name,
    CASE WHEN reason <> '' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day, reason, count(*) AS row_count FROM m GROUP BY ALL"""


@query(INGEST_SQL)
def stream_ingest(t: Tables) -> DataFrame:
    """Every event as a message of one of four topics, streamed into the raw tables and counted there by day and reason.

    Some messages are cut off, some have a time that cannot be read; some have no ``timestamp``, which an envelope must
    have and the other topics make up for by ``event_timestamp``.
    """
    messages = _messages_by_topic(t)
    source, root = scratch_path(t.spark, "messages"), scratch_path(t.spark, "raw")
    messages.write.parquet(source)
    topics = list(ingest.TOPIC_SCHEMAS)
    stream = ingest.read_message_files(t.spark, source)
    ingest.start_ingest(stream, root, scratch_path(t.spark, "ingest-checkpoint"), topics).awaitTermination()
    return _ingested(t, root)


def _ingested(t: Tables, root: str) -> DataFrame:
    """Rows of the raw tables by day, and of the quarantine by reason."""
    counted = None
    for topic in ingest.TOPIC_SCHEMAS:
        name = topic.replace("-", "_")
        rows = t.spark.read.schema(raw_table_schema(topic)).parquet(f"{root}/{name}")
        day = F.concat_ws("-", "year", "month", "day")
        keys = [F.lit(name).alias("table_name"), day.alias("day"), F.lit("").alias("reason")]
        part = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        counted = part if counted is None else counted.unionByName(part)
    rejected = t.spark.read.schema(ingest.MESSAGE_SCHEMA + ", reason string").parquet(f"{root}/quarantine")
    rejected = rejected.groupBy(F.lit("quarantine").alias("table_name"), F.lit("").alias("day"), "reason")
    return counted.unionByName(rejected.agg(F.count(F.lit(1)).alias("row_count")))


@query(
    """SELECT CASE event_id % 4 WHEN 0 THEN 'raw-events' WHEN 1 THEN 'new-user' WHEN 2 THEN 'new-movie' ELSE 'new-rating' END AS topic,
    (('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 6)::INTEGER AS log_partition, count(*) AS messages,
    0::BIGINT AS first_offset, count(*) - 1 AS last_offset, count(*) AS offsets FROM events GROUP BY ALL"""
)
def publish_log(t: Tables) -> DataFrame:
    """Every event published to a message log in two publications: offsets of a partition run on without gaps."""
    path = scratch_path(t.spark, "log")
    rows = _messages_by_topic(t)
    odd = F.col("key").cast("long") % 3 == 0
    message_log.publish_log(rows.where(odd), path, partitions=6)
    message_log.publish_log(rows.where(~odd), path, partitions=6)
    return (
        message_log.read_log(t.spark, path)
        .groupBy("topic", F.col("partition").alias("log_partition"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count_distinct("offset").alias("offsets"),
        )
    )


@query(INGEST_SQL)
def stream_log_ingest(t: Tables) -> DataFrame:
    """The same tables from a message log: published on a stream, read by offsets in several limited batches."""
    source, path, root = (scratch_path(t.spark, name) for name in ("messages", "log", "raw"))
    messages = _messages_by_topic(t)
    messages.write.parquet(source)
    publishing = message_log.start_publishing(
        ingest.read_message_files(t.spark, source), path, scratch_path(t.spark, "publish-checkpoint"), "events", partitions=4
    )
    publishing.awaitTermination()
    limit = sum(message_log.Log(path).ends().values()) // 10 + 1  # of each of four topics
    stream = message_log.stream_log(t.spark, path, list(ingest.TOPIC_SCHEMAS), group="ingest", max_rows=limit)
    checkpoint = scratch_path(t.spark, "ingest-checkpoint")
    running = ingest.start_ingest(stream, root, checkpoint, list(ingest.TOPIC_SCHEMAS), trigger={"processingTime": "0 seconds"})
    try:
        message_log.catch_up(running, path)
    finally:
        running.stop()
    return _ingested(t, root)


@query("SELECT count(*) AS seen, count(DISTINCT event_id) AS keys FROM events")
def stream_batch_hook(t: Tables) -> DataFrame:
    """A hook on the ingest stream that copies every micro-batch: it gets each message once."""
    source, root, copies = (scratch_path(t.spark, name) for name in ("messages", "raw", "copies"))
    _messages_by_topic(t).repartition(3).write.parquet(source)

    def hook(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{copies}/batch={batch_id}")

    stream = ingest.read_message_files(t.spark, source, max_files=2)
    checkpoint = scratch_path(t.spark, "hook-checkpoint")
    ingest.start_ingest(stream, root, checkpoint, list(ingest.TOPIC_SCHEMAS), hook=hook).awaitTermination()
    rows = t.spark.read.schema(ingest.MESSAGE_SCHEMA).parquet(copies)
    return rows.agg(F.count(F.lit(1)).alias("seen"), F.count_distinct("key").alias("keys"))


def _messages_by_topic(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 4
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    written = F.when(F.col("event_id") % 83 == 0, "zz").when(F.col("event_id") % 89 != 0, F.date_format("ts", pattern))
    earlier = F.when(F.col("event_id") % 89 == 0, F.date_format(F.col("ts") - F.expr("INTERVAL 1 DAY"), pattern))
    when = written.alias("timestamp")
    also = earlier.alias("event_timestamp")
    movie = F.get_json_object("props", "$.k").try_cast("bigint").alias("movie_id")
    bodies = [
        F.struct(F.col("event_id").cast("string").alias("id"), when, F.from_json("props", "map<string,string>").alias("payload")),
        F.struct(when, also, "user_id", F.lit("M").alias("gender"), F.lit(25).alias("age"), F.lit(1).alias("occupation")),
        F.struct(when, also, movie, F.col("event_type").alias("title"), F.array("event_type").alias("genres")),
        F.struct(when, also, "user_id", movie, F.lit(4).alias("rating"), F.unix_seconds("ts").alias("rating_timestamp")),
    ]
    topic, body = F.lit(None), F.lit(None)
    for i, name in reversed(list(enumerate(["raw-events", "new-user", "new-movie", "new-rating"]))):
        topic = F.when(kind == i, name).otherwise(topic)
        body = F.when(kind == i, F.to_json(bodies[i])).otherwise(body)
    broken = F.substring(body, F.lit(1), F.lit(12))
    return t.events.select(
        topic.alias("topic"),
        F.col("event_id").cast("string").alias("key"),
        F.when(F.col("event_id") % 97 == 0, broken).otherwise(body).alias("value"),
    )


@query(
    """SELECT user_id, event_type, value, epoch_us(ts) AS event_us FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_online_upsert(t: Tables) -> DataFrame:
    """The newest event per user, kept current by a stream."""
    keys, order = ["user_id"], ["ts", "event_id"]
    path = scratch_path(t.spark, "online")
    stream = _event_stream(t)
    online.start_online_upsert(stream, path, scratch_path(t.spark, "online-checkpoint"), keys, order).awaitTermination()
    rows = online.read_online(t.spark, path, stream.schema, keys, order)
    return rows.select("user_id", "event_type", "value", F.unix_micros("ts").alias("event_us"))


@query(
    """SELECT user_id, event_type, value, epoch_us(ts) AS event_us FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_bucket_upsert(t: Tables) -> DataFrame:
    """The newest event per user in hash buckets, kept current by a stream that rewrites the buckets it touches."""
    root = scratch_path(t.spark, "buckets")
    checkpoint = scratch_path(t.spark, "buckets-checkpoint")
    keys, order = ["user_id"], ["ts", "event_id"]
    buckets.start_upsert(_event_stream(t), root, checkpoint, keys, order, "events", buckets=16).awaitTermination()
    rows = buckets.read(t.spark, root)
    return rows.select("user_id", "event_type", "value", F.unix_micros("ts").alias("event_us"))


def _written(t: Tables, rows: DataFrame, label: str) -> DataFrame:
    """What a stream with timers writes until its watermark has passed all it can."""
    out = scratch_path(t.spark, label)
    with stateful.rocksdb(t.spark):
        windows.start_append(rows, out, scratch_path(t.spark, f"{label}-checkpoint")).awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(out)


@query(
    """WITH pair AS (SELECT * FROM events WHERE event_type IN ('purchase', 'view'))
    SELECT e.event_id, e.user_id, CASE WHEN f.ts >= e.ts - INTERVAL 3 DAY THEN f.value END AS seen__value
    FROM (SELECT * FROM pair WHERE event_type = 'purchase') e
    ASOF LEFT JOIN (SELECT * FROM pair WHERE event_type = 'view') f ON e.user_id = f.user_id AND e.ts >= f.ts
    WHERE epoch_us(e.ts) // 1000 + 1 <= (SELECT epoch_us(max(ts)) // 1000 - 600000 FROM pair)"""
)
def stream_pit_join(t: Tables) -> DataFrame:
    """Purchases with the newest view at or before them, joined on a stream: all that the watermark has passed."""
    events = _event_stream(t).select("event_id", "user_id", "ts", "value", "event_type")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    joined = stateful.point_in_time_stream(purchases, "user_id", "ts", events.where("event_type = 'view'"), VIEW_VALUE)
    return _written(t, joined, "stream-pit").select("event_id", "user_id", "seen__value")


@query(
    """WITH last AS (SELECT user_id AS label, arg_max(latency, (ts, event_id)) AS last_value, epoch_us(max(ts)) AS last_us FROM log GROUP BY user_id)
    SELECT label, last_us, last_value,
    (last_us + 259200000000) // 1000 + 1 <= (SELECT epoch_us(max(ts)) // 1000 - 600000 FROM log) AS stale FROM last""",
    "log",
)
def stream_latest_gauge(t: Tables) -> DataFrame:
    """The last value of every user's gauge on a stream, and whether it is three days behind the watermark."""
    log = _event_stream(t).select("event_id", "ts", "user_id", F.col("value").alias("latency"))
    changes = stateful.latest_gauge_stream(log, "latency", "user_id", "event_id", stale_after=3 * 86400)
    rows = _written(t, changes, "stream-gauge")
    last = rows.groupBy("label").agg(F.max(F.struct("last_us", "stale", "last_value")).alias("l"))
    return last.select("label", "l.last_us", "l.last_value", "l.stale")
