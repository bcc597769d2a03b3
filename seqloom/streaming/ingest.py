"""Topics of JSON messages into date-partitioned raw tables, with a quarantine for unusable messages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqloom.session import committed, delete_path
from seqloom.sources.events import add_date_partition
from seqloom.sources.schemas import MESSAGE_TIME, PARTITION_COLUMNS, TOPIC_KEYS, TOPIC_SCHEMAS

MESSAGE_SCHEMA = "topic string, key string, value string"


def read_kafka(
    spark: SparkSession, servers: str, topics: list[str], group_id: str | None = None, max_offsets: int | None = None
) -> DataFrame:
    """Messages of several topics from the earliest offset on, with where and when the broker had them."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        "topic",
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        F.col("timestamp").alias("broker_time"),
        "partition",
        "offset",
    )


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same messages from Parquet files with columns topic, key and value."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _table(topic: str) -> str:
    return topic.replace("-", "_")


def _unreadable(time: Column) -> Column:
    return time.isNotNull() & F.try_to_timestamp(time).isNull()


def decode(messages: DataFrame, topics: list[str]) -> DataFrame:
    """Messages with one struct per topic (null but for their own), the ``reason`` to reject them or null, and event time.

    A message is rejected if its topic is unknown, if it has a time that cannot be read, or if a field is missing that its
    topic must have: the keys, or id, timestamp and payload of an envelope. A message without any time that is usable
    otherwise gets the time of processing.
    """
    reason = F.lit("unknown topic")
    times = []
    out = messages
    for topic in topics:
        schema = StructType([*TOPIC_SCHEMAS[topic].fields, MESSAGE_TIME])
        own, event = F.col("topic") == topic, F.col(f"_{_table(topic)}")
        out = out.withColumn(f"_{_table(topic)}", F.when(own, F.from_json("value", schema)))
        missing = reduce(Column.__or__, [event[c].isNull() for c in TOPIC_KEYS[topic]])
        late = _unreadable(event["timestamp"]) | _unreadable(event["event_timestamp"])
        broken = F.when(event.isNull(), "incomplete").when(late, "unreadable time").when(missing, "incomplete")
        reason = F.when(own, broken).otherwise(reason)
        times += [F.try_to_timestamp(event["timestamp"]), F.try_to_timestamp(event["event_timestamp"])]
    out = out.withColumn("reason", reason)
    out = out.withColumn("_time", F.coalesce(*times, F.current_timestamp()))
    return out


def raw_rows(decoded: DataFrame, topic: str) -> DataFrame:
    """Rows of the raw table of a topic, with event time and date columns."""
    own = decoded.where((F.col("topic") == topic) & F.col("reason").isNull())
    event = F.col(f"_{_table(topic)}")
    fields = [event[f].alias(f) for f in TOPIC_SCHEMAS[topic].names]
    return add_date_partition(own.select(*fields, F.col("_time").alias("event_timestamp")))


def _write_tables(root: str, topics: list[str], hook: Callable[[DataFrame, int], None] | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is read and decoded once, into shared files. A batch that is replayed after a failure finds them and
        # with them its processing time, and replaces its own directories, the last level of each table.
        spark = batch.sparkSession
        path = f"{root}/_decoded/batch={batch_id}"
        if not committed(spark, path):
            decode(batch, topics).write.mode("overwrite").parquet(path)
        staged = spark.read.schema(decode(batch, topics).schema).parquet(path)
        number = F.lit(batch_id).alias("batch")
        for topic in topics:
            rows = raw_rows(staged, topic).hint("rebalance", *PARTITION_COLUMNS).select("*", number)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *PARTITION_COLUMNS, "batch"
            ).parquet(f"{root}/{_table(topic)}")
        rejected = staged.where("reason IS NOT NULL").select(*batch.columns, "reason", number)
        rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(
            f"{root}/quarantine"
        )
        if hook:
            hook(staged.select(*batch.columns), batch_id)
        for old in committed(spark, f"{root}/_decoded/batch=*"):
            if int(old.rpartition("=")[2]) < batch_id:
                delete_path(spark, old)

    return write


def start_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    topics: list[str],
    *,
    hook: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Fan messages out to one raw table per topic below ``root``; ``hook`` sees every micro-batch as well."""
    return (
        messages.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(_write_tables(root, topics, hook))
        .start()
    )


def start_single_table(messages: DataFrame, topic: str, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """One topic into one table with the exactly-once file sink."""
    return (
        raw_rows(decode(messages, [topic]), topic)
        .writeStream.format("parquet")
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

