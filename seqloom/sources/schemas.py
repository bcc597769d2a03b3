"""Explicit schemas of messages and raw tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


ENVELOPE = _struct(id=StringType(), timestamp=StringType(), payload=MapType(StringType(), StringType()))

NEW_USER = _struct(
    event_type=StringType(),
    timestamp=StringType(),
    user_id=LongType(),
    gender=StringType(),
    age=IntegerType(),
    occupation=IntegerType(),
    zip_code=StringType(),
)

NEW_MOVIE = _struct(
    event_type=StringType(),
    timestamp=StringType(),
    movie_id=LongType(),
    title=StringType(),
    genres=ArrayType(StringType()),
)

NEW_RATING = _struct(
    event_type=StringType(),
    timestamp=StringType(),
    user_id=LongType(),
    movie_id=LongType(),
    rating=IntegerType(),
    rating_timestamp=LongType(),
)

TOPIC_SCHEMAS = {"raw-events": ENVELOPE, "new-user": NEW_USER, "new-movie": NEW_MOVIE, "new-rating": NEW_RATING}

TOPIC_SCHEMAS["processed-events"] = ENVELOPE

# second choice for the time of a message; the raw tables hold the derived time under this name
MESSAGE_TIME = StructField("event_timestamp", StringType())

# the columns that must be present for a message of the topic to be usable
TOPIC_KEYS = {
    "raw-events": ["id", "timestamp", "payload"],
    "processed-events": ["id", "timestamp", "payload"],
    "new-user": ["user_id"],
    "new-movie": ["movie_id"],
    "new-rating": ["user_id", "movie_id"],
}

PARTITION_COLUMNS = ["year", "month", "day"]


def raw_table_schema(topic: str) -> StructType:
    """Schema of the partitioned raw table of a topic; partition values stay zero-padded text."""
    fields = [*TOPIC_SCHEMAS[topic].fields, StructField("event_timestamp", TimestampType())]
    return StructType([*fields, *[StructField(c, StringType()) for c in PARTITION_COLUMNS]])
