"""Projection, coercion, null handling and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.skew import first_rows_per_key

STAGED_COLUMNS = ["user_id", "event_timestamp", "gender_idx", "age_idx", "occupation", "target", "target_time"]
POSITIVE_RATING = 3


def staging_projection(samples: DataFrame) -> DataFrame:
    return samples.select(*STAGED_COLUMNS).where(F.col("event_timestamp").isNotNull())


def coerce_numeric(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def dedup_by_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in ``order``, which must be unique inside a key to be repeatable."""
    return first_rows_per_key(df, keys, order, 1).drop("_rn")


def positive_interactions(ratings: DataFrame, minimum: float = POSITIVE_RATING) -> DataFrame:
    return ratings.where(F.col("rating") >= minimum)


def entity_frame(events: DataFrame, entity: str = "user_id", time: str = "event_timestamp") -> DataFrame:
    return events.select(entity, time)


def restrict_to_entities(df: DataFrame, entities: DataFrame, key: str = "user_id") -> DataFrame:
    """Rows whose key is in ``entities``; the id list is a table, however long it is."""
    # a listed id may repeat, and that side of a semi join is not split when it is skewed
    return df.join(entities.select(key).distinct(), key, "left_semi")


def flatten_samples(samples: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Samples with a nested profile as plain rows with an event time; ``keep`` names further columns."""
    return samples.select(
        *(keep or []),
        "user_id",
        F.timestamp_seconds("last_timestamp").alias("event_timestamp"),
        "item_seq",
        "genre_seq",
        "time_seq",
        "target",
        "target_time",
        "user_profile.age_idx",
        "user_profile.gender_idx",
        "user_profile.occupation",
    )


def minmax_normalize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale columns to [0, 1]; a column with one value, or none, is left as it is."""
    bounds = df.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).alias("b")
    ).scalar()

    def scaled(c: str) -> Column:
        lo, hi = bounds[c]["lo"], bounds[c]["hi"]
        return F.when(hi != lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.col(c))

    return df.withColumns({c: scaled(c) for c in columns})


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing from one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_rows(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)
