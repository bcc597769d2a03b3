"""Feature tables and the lookups on them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions import encode
from seqloom.functions.vocab import FEATURE_COLS, GENRES
from seqloom.operators.index import apply_index, dense_index
from seqloom.operators.skew import fill_forward, last_rows_per_key
from seqloom.session import materialize

DAY = 86_400


@dataclass(frozen=True)
class FeatureView:
    """Named, time-stamped feature columns of one entity.

    ``tie`` orders rows of one entity and one time; ``ttl_seconds`` is how long a row stays valid; ``static`` marks
    views whose values do not change, for which a plain lookup replaces the point-in-time join.
    """

    name: str
    entity: str
    time: str
    features: list[str]
    ttl_seconds: int = 3650 * DAY
    tie: list[str] = field(default_factory=list)
    static: bool = False


@dataclass(frozen=True)
class FeatureService:
    """A named selection over feature views."""

    name: str
    views: list[FeatureView]

    @property
    def columns(self) -> list[str]:
        return [f for v in self.views for f in v.features]


def select_service(df: DataFrame, service: FeatureService, extra: list[str] | None = None) -> DataFrame:
    return df.select(*(extra or []), *service.columns)


def user_features(users: DataFrame) -> DataFrame:
    """One row per distinct combination of user attributes with the time it was last seen."""
    return (
        users.groupBy("user_id", "gender", "age", "occupation")
        .agg(F.max("event_timestamp").alias("event_timestamp"))
        .select(
            "user_id",
            "event_timestamp",
            encode.gender_code_strict(F.col("gender")).alias("gender_idx"),
            encode.age_bucket(F.col("age")).alias("age_idx"),
            "occupation",
        )
    )


def movie_versions(movies: DataFrame) -> DataFrame:
    return movies.groupBy("movie_id", "genres").agg(F.max("event_timestamp").alias("event_timestamp"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key; each map task forwards at most one row per key."""
    return last_rows_per_key(df, keys, order, 1).drop("_rn")


def movie_features(movies: DataFrame, vocabulary: list[str] = GENRES) -> DataFrame:
    """Latest genres per movie, encoded into three columns, with the dense movie index."""
    known = movies.select("movie_id", "genres", "event_timestamp").where("movie_id is not null")
    latest = latest_per_key(known, ["movie_id"], ["event_timestamp", "genres"])
    codes = encode.genre_codes(F.col("genres"), vocabulary)
    # one row per movie is left here, and the index is numbered from the same written rows
    staged = materialize(latest.select("movie_id", "event_timestamp", codes.alias("g")), "latest-movies")
    return apply_index(staged, dense_index(staged, "movie_id", "internal_movie_id", distinct=True), "movie_id").select(
        "movie_id",
        "internal_movie_id",
        "event_timestamp",
        *[F.get("g", F.lit(i)).alias(f"genre_idx_{i}") for i in range(encode.MAX_GENRES)],
    )


def rating_events(ratings: DataFrame, index: DataFrame) -> DataFrame:
    """Positive ratings on the dense movie index with their time slot."""
    return (
        ratings.where("rating >= 3")
        .join(index.select("movie_id", "internal_movie_id"), "movie_id")
        .withColumn("time_slot", encode.time_slot(F.col("rating_timestamp")))
        .withColumn("rating", F.col("rating").cast("float"))
    )


def vocabulary_sizes(users: DataFrame, movies: DataFrame, genres: int = len(GENRES)) -> DataFrame:
    """Sizes of every embedding table, index 0 included where it is padding."""
    user_sizes = users.agg(
        F.count_distinct("user_id").alias("num_users"),
        F.greatest(F.lit(21), F.max("occupation") + 1).alias("num_occupations"),
    )
    items = movies.agg((F.count_distinct("movie_id") + 1).alias("num_items")).scalar()
    return user_sizes.select(
        items.alias("num_items"),
        F.lit(genres + 1).alias("num_genres"),
        F.lit(7).alias("num_ages"),
        F.lit(2).alias("num_genders"),
        "num_occupations",
        F.lit(3).alias("num_time_slots"),
        F.lit(encode.MAX_GENRES).alias("max_genres_per_item"),
        "num_users",
    )


def time_slot_distribution(ratings: DataFrame) -> DataFrame:
    """Ratings per time slot, slots without ratings included."""
    counted = ratings.groupBy(encode.time_slot(F.col("rating_timestamp")).alias("time_slot")).agg(
        F.count(F.lit(1)).alias("ratings")
    )
    slots = ratings.sparkSession.range(3).select(F.col("id").cast("int").alias("time_slot"))
    return slots.join(counted, "time_slot", "left").select("time_slot", F.coalesce("ratings", F.lit(0)).alias("ratings"))


def join_latest(events: DataFrame, features: DataFrame, view: FeatureView) -> DataFrame:
    """Static-feature join: every event with the newest row of its entity."""
    latest = latest_per_key(features, [view.entity], [view.time, *view.tie])
    return events.join(latest.select(view.entity, *view.features), view.entity, "left")


def training_features(events: DataFrame, users: DataFrame, view: FeatureView) -> DataFrame:
    """Events with encoded user features; events of users without complete features are dropped."""
    return join_latest(events, users, view).na.drop(subset=view.features)


def point_in_time_join(
    events: DataFrame,
    entity: str,
    time: str,
    views: list[tuple[DataFrame, FeatureView]],
    *,
    max_rows: int | None = None,
) -> DataFrame:
    """Per event and view, the newest feature row at or before the event, null once older than the view's TTL.

    Events and all views are stacked and each view's row is carried forward along the entity's time line: one
    exchange and one sort however many views there are, linear in the rows. Hot entities are cut into chunks.
    Feature columns come out as ``<view>__<feature>`` with ``<view>__time``. An event without an entity has no features, and
    feature rows without one are left out; neither takes part in the exchange. A view's rows of one entity and time must be
    told apart by its ``tie``.
    """
    named = F.col(entity).isNotNull()
    nameless, events = events.where(~named), events.where(named)
    views = [(frame.where(F.col(v.entity).isNotNull()), v) for frame, v in views]
    spine = [F.col(entity).alias("_entity"), F.col(time).alias("_time")]
    slots = {v.name: f"_f_{v.name}" for _, v in views}
    stacked = events.select(*spine, F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_event"))
    for frame, v in views:
        row = F.struct(F.col(v.time).alias("time"), *v.features)
        rows = frame.select(
            F.col(v.entity).alias("_entity"),
            F.col(v.time).alias("_time"),
            F.lit(0).alias("_kind"),
            *[F.col(t).alias(f"_t_{v.name}_{i}") for i, t in enumerate(v.tie)],
            row.alias(slots[v.name]),
        )
        stacked = stacked.unionByName(rows, allowMissingColumns=True)
    ties = [f"_t_{v.name}_{i}" for _, v in views for i in range(len(v.tie))]
    entities = [events.select(F.col(entity).alias("_entity"))]
    entities += [frame.select(F.col(v.entity).alias("_entity")) for frame, v in views]
    filled = fill_forward(
        stacked,
        ["_entity"],
        ["_time", "_kind", *ties],
        list(slots.values()),
        size_from=reduce(DataFrame.unionByName, entities),
        max_rows=max_rows,
    ).where(F.col("_kind") == 1)

    out = ["_event.*"]
    for _, v in views:
        slot = F.col(slots[v.name])
        fresh = F.col("_time") <= slot["time"] + F.make_dt_interval(secs=F.lit(v.ttl_seconds))
        out.append(F.when(fresh, slot["time"]).alias(f"{v.name}__time"))
        out += [F.when(fresh, slot[f]).alias(f"{v.name}__{f}") for f in v.features]
    return filled.select(*out).unionByName(nameless, allowMissingColumns=True)


def attach_views(
    events: DataFrame, entity: str, time: str, views: list[tuple[DataFrame, FeatureView]], *, max_rows: int | None = None
) -> DataFrame:
    """Features of several views: a latest-row lookup for static views, a point-in-time join for the others."""
    moving = [(df, v) for df, v in views if not v.static]
    out = point_in_time_join(events, entity, time, moving, max_rows=max_rows) if moving else events
    for df, v in views:
        if v.static:
            named = latest_per_key(df, [v.entity], [v.time, *v.tie]).select(
                F.col(v.entity).alias(entity), *[F.col(f).alias(f"{v.name}__{f}") for f in v.features]
            )
            out = out.join(named, entity, "left")
    return out


def materialize_window(features: DataFrame, view: FeatureView, end: str, days: int = 7) -> DataFrame:
    """Newest row per entity inside ``[end - days, end]``, the content of the online table."""
    upto = F.lit(end).cast("timestamp")
    inside = F.col(view.time).between(upto - F.make_dt_interval(days=F.lit(days)), upto)
    return latest_per_key(features.where(inside), [view.entity], [view.time, *view.tie])


def online_upsert(online: DataFrame, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The online table after writing ``rows``: per key, the newest of old and new."""
    return latest_per_key(online.unionByName(rows), [key], order)


def online_lookup(requests: DataFrame, online: DataFrame, key: str = "user_id", features: list[str] = FEATURE_COLS) -> DataFrame:
    """Requested ids with their online features; ``is_miss`` when every feature is null.

    Columns of the requests, such as an ordinal to sort the answer by, are kept.
    """
    found = requests.join(online.select(key, *features), key, "left")
    return found.withColumn("is_miss", F.forall(F.array(*[F.col(c).isNull() for c in features]), lambda x: x))


def newest_missed(
    looked_up: DataFrame, offline: DataFrame, order: list[str], key: str = "user_id"
) -> DataFrame:
    """Newest offline row of every id that missed; only rows of those ids take part in the search.

    These are also the rows to write back, with ``online_upsert``, so that the next lookup finds them.
    """
    missed = looked_up.where("is_miss").select(key).distinct()
    return latest_per_key(offline.join(missed, key, "left_semi"), [key], order)


def online_lookup_with_fallback(
    requests: DataFrame,
    online: DataFrame,
    offline: DataFrame,
    order: list[str],
    key: str = "user_id",
    features: list[str] = FEATURE_COLS,
) -> DataFrame:
    """Online features, and for misses the newest offline row; ``feature_source`` tells which was used."""
    looked_up = online_lookup(requests, online, key, features)
    newest = newest_missed(looked_up, offline, order, key).select(
        key, F.lit(True).alias("_in_offline"), *[F.col(c).alias(f"_off_{c}") for c in features]
    )
    joined = looked_up.join(newest, key, "left")
    return joined.select(
        *requests.columns,
        *[F.when(F.col("is_miss"), F.col(f"_off_{c}")).otherwise(F.col(c)).alias(c) for c in features],
        F.when(~F.col("is_miss"), "online")
        .when(F.col("_in_offline"), "offline")
        .otherwise("missing")
        .alias("feature_source"),
    )


def feature_missing_rate(df: DataFrame, features: list[str]) -> DataFrame:
    """Share of null values per feature, all features in one pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in features])
    return rates.unpivot([], features, "feature", "missing_rate")
