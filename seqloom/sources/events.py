"""JSON event messages: encoding, validation, routing and the date-partitioned raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from seqloom.sources.schemas import ENVELOPE, PARTITION_COLUMNS


def encode_events(df: DataFrame, key: list[str], topic: str, columns: list[str]) -> DataFrame:
    """One message per row: topic, key and the chosen columns as JSON."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.concat_ws("-", *[F.col(k).cast("string") for k in key]).alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def publish(messages: DataFrame, *, servers: str | None = None, path: str | None = None) -> None:
    """Send messages to Kafka, or append them as Parquet files where there is no broker."""
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        messages.write.mode("append").parquet(path)


def parse_value(messages: DataFrame, schema: StructType) -> DataFrame:
    """The message columns plus the decoded value as ``event``."""
    return messages.withColumn("event", F.from_json(F.col("value").cast("string"), schema))


def _is_valid_envelope() -> Column:
    # a broken text decodes to a struct of nulls, so the fields are tested, not the struct
    return (
        F.col("event.id").isNotNull()
        & F.try_to_timestamp("event.timestamp").isNotNull()
        & F.col("event.payload").isNotNull()
    )


def validate_events(messages: DataFrame) -> DataFrame:
    """Envelopes with id, readable timestamp and payload object."""
    return parse_value(messages, ENVELOPE).where(_is_valid_envelope()).select("event.*")


def quarantine_events(messages: DataFrame) -> DataFrame:
    """The messages that ``validate_events`` leaves out, as they came."""
    return parse_value(messages, ENVELOPE).where(~F.coalesce(_is_valid_envelope(), F.lit(False))).drop("event")


def accepted_per_topic(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("accepted"))


def table_name(topic: Column) -> Column:
    return F.translate(topic, "-", "_")


def derive_event_time(df: DataFrame, timestamp: str = "timestamp", fallback: str | None = "event_timestamp") -> DataFrame:
    """Event time per row: the message's own time, else ``fallback``, else the time of processing."""
    choices = [F.try_to_timestamp(timestamp)]
    if fallback and fallback in df.columns:
        text = dict(df.dtypes)[fallback] == "string"
        choices.append(F.try_to_timestamp(fallback) if text else F.col(fallback))
    return df.withColumn("event_timestamp", F.coalesce(*choices, F.current_timestamp()))


def add_date_partition(df: DataFrame, time: str = "event_timestamp") -> DataFrame:
    patterns = dict(zip(PARTITION_COLUMNS, ["yyyy", "MM", "dd"], strict=True))
    return df.withColumns({c: F.date_format(time, p) for c, p in patterns.items()})


def append_raw(df: DataFrame, path: str) -> None:
    """Append to a raw table under ``year=/month=/day=``.

    Rows of one date are brought together first, so that a load over many dates does not leave one small file per
    task and date; the rebalance step splits a date that is too large for one task.
    """
    rows = add_date_partition(df).hint("rebalance", *PARTITION_COLUMNS)
    rows.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def read_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All files of a raw table, any date; an empty frame when nothing was written yet."""
    from seqloom.sources.tables import read_or_empty

    return read_or_empty(spark, path, schema)
