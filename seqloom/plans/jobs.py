"""End-to-end jobs: raw tables to staged features, split tables, staged samples and the online table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import encode
from seqloom.functions.vocab import GENRES
from seqloom.operators import clean, features, index, sequences
from seqloom.operators.contract import require_rows
from seqloom.operators.features import FeatureView
from seqloom.sources.events import read_raw
from seqloom.sources.schemas import raw_table_schema
from seqloom.session import materialize, scratch_files
from seqloom.sources.tables import overwrite_table, write_document

RATING_ORDER = ["rating_timestamp", "movie_id"]


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Users, movies and ratings as the ingest stream wrote them; an empty table is an error."""
    names = {"users": "new-user", "movies": "new-movie", "ratings": "new-rating"}
    return {
        name: require_rows(read_raw(spark, f"{root}/{topic.replace('-', '_')}", raw_table_schema(topic)), name)
        for name, topic in names.items()
    }


def stage_features(spark: SparkSession, raw_root: str, out: str, vocabulary: list[str] = GENRES) -> None:
    """Feature tables, id map, catalog and vocabulary sizes below ``out``."""
    with scratch_files(spark):
        raw = raw_tables(spark, raw_root)
        overwrite_table(features.user_features(raw["users"]), f"{out}/user_features")
        overwrite_table(features.movie_features(raw["movies"], vocabulary), f"{out}/movie_features")
        staged = spark.read.parquet(f"{out}/movie_features")
        events = features.rating_events(raw["ratings"], staged)
        overwrite_table(
            events.select("user_id", "event_timestamp", "internal_movie_id", "rating", "time_slot", "rating_timestamp"),
            f"{out}/rating_events",
        )
        write_document(index.reverse_index(staged, "movie_id", "internal_movie_id"), f"{out}/id_map")
        catalog = features.latest_per_key(raw["movies"], ["movie_id"], ["event_timestamp", "title", "genres"])
        write_document(catalog.select("movie_id", "title", "genres"), f"{out}/movies")
        write_document(features.vocabulary_sizes(raw["users"], raw["movies"], len(vocabulary)), f"{out}/metadata")


def encoded_tables(raw: dict[str, DataFrame], vocabulary: list[str] = GENRES) -> dict[str, DataFrame]:
    """Users, movies and ratings cleaned and encoded with the tolerant rules.

    Numbers that cannot be read become null, rows without keys go, one row per key stays: the newest.
    """

    def newest(df: DataFrame) -> list[Column]:
        # rows of one time are told apart by their content
        return [F.col("event_timestamp").desc(), F.xxhash64(*df.columns)]

    users = clean.coerce_numeric(raw["users"], {"user_id": "bigint", "age": "int", "occupation": "int"})
    users = clean.dedup_by_key(clean.drop_null_keys(users, ["user_id"]), ["user_id"], newest(users))
    users = index.label_encode(users.select("user_id", "gender", "age", "occupation"), "age", "age_idx")
    movies = clean.coerce_numeric(raw["movies"], {"movie_id": "bigint"})
    movies = clean.dedup_by_key(clean.drop_null_keys(movies, ["movie_id"]), ["movie_id"], newest(movies))
    kinds = {"user_id": "bigint", "movie_id": "bigint", "rating": "double", "rating_timestamp": "bigint"}
    ratings = clean.drop_null_keys(clean.coerce_numeric(raw["ratings"], kinds), ["user_id", "movie_id", "rating"])
    return {
        "users": users.select(
            "user_id", "age_idx", encode.gender_code(F.col("gender")).alias("gender_idx"), "occupation"
        ),
        "movies": movies.select("movie_id", encode.genre_codes(F.col("genres"), vocabulary).alias("genres")),
        "ratings": ratings.select(*kinds),
    }


def build_split_tables(
    spark: SparkSession,
    raw_root: str,
    out: str,
    *,
    order: list[str] = RATING_ORDER,
    max_train_per_user: int | None = None,
    vocabulary: list[str] = GENRES,
) -> None:
    """Train, validation and test tables of flat samples below ``out``, on the index of positively rated movies."""
    with scratch_files(spark):
        encoded = encoded_tables(raw_tables(spark, raw_root), vocabulary)
        joined = clean.positive_interactions(encoded["ratings"]).join(encoded["movies"], "movie_id")
        joined = joined.join(encoded["users"].select("user_id"), "user_id", "left_semi")
        # read for the index and again for the samples
        joined = materialize(joined, "positive-ratings")
        overwrite_table(index.dense_index(joined, "movie_id", "item"), f"{out}/item_index")
        events = joined.join(spark.read.parquet(f"{out}/item_index"), "movie_id").withColumn(
            "slot", encode.time_slot(F.col("rating_timestamp"))
        )
        samples = sequences.training_samples(
            events,
            order,
            max_train_per_user=max_train_per_user,
            profiles=encoded["users"],
            size_from=joined,
        )
        # one pass writes all three tables, as directories of one dataset
        flat = clean.flatten_samples(samples, keep=["split"])
        flat.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("split").parquet(f"{out}/samples")


def read_split(spark: SparkSession, out: str, split: str) -> DataFrame:
    return spark.read.parquet(f"{out}/samples").where(F.col("split") == split).drop("split")


def stage_samples(spark: SparkSession, split_root: str, out: str, view: FeatureView, end: str, days: int = 7) -> None:
    """Staged rows of the train table, and the online table with the newest row per user inside the window."""
    with scratch_files(spark):
        staged = clean.staging_projection(read_split(spark, split_root, "train"))
        overwrite_table(require_rows(staged, "train samples"), f"{out}/staged")
        online = features.materialize_window(spark.read.parquet(f"{out}/staged"), view, end, days)
        overwrite_table(online, f"{out}/online")
