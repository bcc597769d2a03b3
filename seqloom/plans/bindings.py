"""The sample tables seen as users, movies, ratings and a prediction log, in Spark and as SQL for the checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import encode
from seqloom.operators import clean, features, index, recommend, sequences
from seqloom.operators.features import DAY, FeatureService, FeatureView
from seqloom.session import materialize

# Vocabulary of the sample catalog, index = position starting at 1.
PART_GENRES = [
    "anvil",
    "blue",
    "bolt",
    "cold",
    "gear",
    "gizmo",
    "hot",
    "large",
    "new",
    "old",
    "plate",
    "red",
    "ring",
    "rod",
    "small",
    "widget",
    "ECONOMY",
    "PROMO",
]
VECTOR_DIM = 64
#: Train positions per user that a classifier is fitted on; bounds the labelled rows of the fit.
FIT_POSITIONS = 20
RATING_ORDER = ["rating_timestamp", "event_id"]
BIG_ORDER = ["rating_timestamp", "l_orderkey", "l_linenumber", "l_suppkey", "movie_id"]

TABLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

PROFILE_VIEW = FeatureView(
    "profile", "user_id", "event_timestamp", ["gender_idx", "age_idx", "occupation"], tie=["occupation"], static=True
)
VIEW_VALUE = FeatureView("seen", "user_id", "ts", ["value"], ttl_seconds=3 * DAY, tie=["event_id"])
ORDER_VALUE = FeatureView("spend", "user_id", "ts", ["o_totalprice"], ttl_seconds=365 * DAY, tie=["o_orderkey"])
SAMPLE_VIEW = FeatureView(
    "raw_event_features",
    "user_id",
    "event_timestamp",
    ["gender_idx", "age_idx", "occupation", "target_time"],
    ttl_seconds=7 * DAY,
    tie=["target"],
)
SERVICE = FeatureService("event_features_service", [SAMPLE_VIEW])


class Tables:
    """Frames derived from the Parquet tables below ``root``; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, root: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """A table by its declared schema, or by the schema in its files."""
        reader = self.spark.read
        if name in TABLE_SCHEMAS:
            reader = reader.schema(TABLE_SCHEMAS[name])
        return reader.parquet(self.path(name))

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def ratings(self) -> DataFrame:
        kind = F.col("event_type")
        stars = F.when(kind == "error", 1).when(kind == "view", 2).when(kind == "click", 3).when(kind == "signup", 4)
        return self.events.select(
            "event_id",
            "user_id",
            F.get_json_object("props", "$.k").try_cast("bigint").alias("movie_id"),
            stars.otherwise(5).alias("rating"),
            F.unix_seconds("ts").alias("rating_timestamp"),
            F.col("ts").alias("event_timestamp"),
        )

    @cached_property
    def ratings_big(self) -> DataFrame:
        return (
            self.read("lineitem")
            .join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("user_id"),
                F.col("l_partkey").alias("movie_id"),
                (1 + F.col("l_quantity").cast("int") % 5).alias("rating"),
                F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("rating_timestamp"),
                "l_orderkey",
                "l_linenumber",
                "l_suppkey",
            )
        )

    @cached_property
    def movie_rows(self) -> DataFrame:
        """Two versions of every third movie: the later one has its type in front of the genres."""
        none = F.array().cast("array<string>")
        genres = F.concat(
            F.when(F.col("version") == 1, F.array("p_type")).otherwise(none),
            F.split("p_name", " "),
            F.when(F.col("p_size") % 2 == 0, F.array("p_type")).otherwise(none),
            F.when(F.col("p_size") % 5 == 0, F.array("p_brand")).otherwise(none),
        )
        return _versions(self.read("part"), F.col("p_size") % 3 == 0).select(
            F.col("p_partkey").alias("movie_id"),
            F.col("p_name").alias("title"),
            genres.alias("genres"),
            _version_time(F.col("p_partkey")).alias("event_timestamp"),
            "p_size",
        )

    @cached_property
    def movies(self) -> DataFrame:
        return features.latest_per_key(self.movie_rows, ["movie_id"], ["event_timestamp"])

    @cached_property
    def movie_features(self) -> DataFrame:
        return features.movie_features(self.movie_rows, PART_GENRES)

    @cached_property
    def user_rows(self) -> DataFrame:
        """Users with a second version, one day later, for every even id."""
        key = F.col("c_custkey")
        gender = F.when(F.col("c_acctbal") < 0, "F").when(key % 7 == 0, " f ").when(key % 11 == 5, "?").otherwise("M")
        ages = F.array(*[F.lit(a) for a in (1, 18, 25, 35, 45, 50, 56)])
        return _versions(self.read("customer"), key % 2 == 0).select(
            key.alias("user_id"),
            gender.alias("gender"),
            F.get(ages, F.col("c_nationkey") % 7).alias("age"),
            (F.col("c_nationkey") % 21 + F.col("version")).alias("occupation"),
            _version_time(key).alias("event_timestamp"),
            "version",
        )

    @cached_property
    def users(self) -> DataFrame:
        """First versions only, one row per customer."""
        return self.user_rows.where("version = 0").drop("version")

    @cached_property
    def encoded_users(self) -> DataFrame:
        return self.user_rows.select(
            "user_id",
            "event_timestamp",
            encode.gender_code(F.col("gender")).alias("gender_idx"),
            encode.age_bucket(F.col("age")).alias("age_idx"),
            "occupation",
        )

    @cached_property
    def profiles(self) -> DataFrame:
        return features.latest_per_key(self.encoded_users, ["user_id"], ["event_timestamp"])

    @cached_property
    def rating_events(self) -> DataFrame:
        return features.rating_events(self.ratings, self.movie_features)

    def _sequence_events(self, ratings: DataFrame, order: list[str]) -> DataFrame:
        codes = self.movie_features.select(
            "movie_id",
            F.col("internal_movie_id").alias("item"),
            F.array("genre_idx_0", "genre_idx_1", "genre_idx_2").alias("genres"),
        )
        return (
            ratings.where("rating >= 3")
            .join(codes, "movie_id")
            .select(
                "user_id",
                "item",
                "genres",
                encode.time_slot(F.col("rating_timestamp")).alias("slot"),
                *dict.fromkeys([*order, "rating_timestamp"]),
            )
        )

    @cached_property
    def sequence_events(self) -> DataFrame:
        return self._sequence_events(self.ratings, RATING_ORDER)

    @cached_property
    def sequence_events_big(self) -> DataFrame:
        return self._sequence_events(self.ratings_big, BIG_ORDER)

    @cached_property
    def samples(self) -> DataFrame:
        """Samples of all positions with profiles."""
        return sequences.training_samples(
            self.sequence_events, RATING_ORDER, profiles=self.profiles, size_from=self.ratings
        )

    @cached_property
    def capped_samples(self) -> DataFrame:
        """Samples of the last positions, to bound what a classifier is fitted on."""
        return sequences.training_samples(
            self.sequence_events, RATING_ORDER, max_train_per_user=FIT_POSITIONS, profiles=self.profiles
        )

    @cached_property
    def fit_table(self) -> DataFrame:
        """The flat rows a classifier is fitted on, staged."""
        return materialize(clean.staging_projection(clean.flatten_samples(self.capped_samples)), "fit-rows")

    @cached_property
    def staged_samples(self) -> DataFrame:
        """Samples as flat rows."""
        return clean.staging_projection(clean.flatten_samples(self.samples))

    @cached_property
    def staged_table(self) -> DataFrame:
        """The same rows staged as files, for jobs that read them more than once."""
        return materialize(self.staged_samples, "staged-samples")

    @cached_property
    def vector_index(self) -> DataFrame:
        ids = self.read("embeddings").select(F.col("vec_id").alias("movie_id"))
        return materialize(index.dense_index(ids, "movie_id"), "vector-index")

    @cached_property
    def item_vectors(self) -> DataFrame:
        vectors = self.read("embeddings").select(F.col("vec_id").alias("movie_id"), F.col("embedding").alias("vec"))
        return vectors.join(self.vector_index, "movie_id").select(F.col("item_idx").alias("item"), "vec")

    @cached_property
    def vector_events(self) -> DataFrame:
        """Positive ratings on the index of the items that have a vector."""
        return (
            self.ratings.where("rating >= 3")
            .join(self.vector_index, "movie_id")
            .select(
                "user_id",
                F.col("item_idx").alias("item"),
                encode.time_slot(F.col("rating_timestamp")).alias("slot"),
                F.array().cast("array<int>").alias("genres"),
                "rating_timestamp",
                "event_id",
            )
        )

    @cached_property
    def pairs(self) -> DataFrame:
        """Interactions per user and item, staged because several steps of a recommendation read them."""
        return materialize(recommend.interaction_counts(self.vector_events), "pairs")

    @cached_property
    def log(self) -> DataFrame:
        return self.events.select(
            "event_id",
            "ts",
            "user_id",
            F.col("value").alias("latency"),
            (F.col("value") / 100).alias("prediction"),
            (F.col("event_type") == "error").alias("is_error"),
            F.col("event_type").alias("label"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Every event as a JSON message; some are cut in half, some have no timestamp."""
        whole = F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("id"),
                F.when(F.col("event_id") % 89 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
                F.from_json("props", "map<string,string>").alias("payload"),
            )
        )
        cut = F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
        topics = F.array(*[F.lit(t) for t in ("raw-events", "new-user", "new-movie", "new-rating")])
        return self.events.select(
            F.get(topics, (F.col("event_id") % 4).cast("int")).alias("topic"),
            F.col("event_id").cast("string").alias("key"),
            F.when(F.col("event_id") % 97 == 0, cut).otherwise(whole).alias("value"),
            "event_id",
            "ts",
        )


def _versions(rows: DataFrame, twice: Column) -> DataFrame:
    """Rows as version 0 and, where ``twice`` holds, as version 1 too."""
    return rows.withColumn("version", F.explode(F.sequence(F.lit(0), F.when(twice, 1).otherwise(0))))


def _version_time(key: Column) -> Column:
    """A day of December 2023 by the key; version 1 is a day later."""
    return F.timestamp_seconds(F.lit(1_701_388_800) + (key % 30 + F.col("version")) * DAY)


# --- the same bindings as DuckDB SQL -----------------------------------------------------------------------------

_VOCAB = "[" + ", ".join(f"'{g}'" for g in PART_GENRES) + "]"

SLOT_SQL = (
    "CAST(CASE WHEN hour(to_timestamp(rating_timestamp) AT TIME ZONE 'UTC') BETWEEN 6 AND 17 THEN 0 "
    "WHEN hour(to_timestamp(rating_timestamp) AT TIME ZONE 'UTC') BETWEEN 18 AND 21 THEN 1 ELSE 2 END AS INTEGER)"
)


def genre_sql(k: int, source: str = "genres") -> str:
    return f"CAST(coalesce(list_position({_VOCAB}, {source}[{k + 1}]), 0) AS INTEGER)"


_CTES: dict[str, tuple[list[str], str]] = {
    "ratings": (
        [],
        """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS movie_id,
        CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS rating,
        CAST(floor(epoch(ts)) AS BIGINT) AS rating_timestamp, ts AS event_timestamp FROM events""",
    ),
    "ratings_big": (
        [],
        """SELECT o_custkey AS user_id, l_partkey AS movie_id, 1 + CAST(l_quantity AS INTEGER) % 5 AS rating,
        CAST(epoch(l_shipdate) AS BIGINT) AS rating_timestamp, l_orderkey, l_linenumber, l_suppkey
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "movie_base": (
        [],
        """SELECT p_partkey AS movie_id, p_name AS title,
        list_concat(list_concat(string_split(p_name, ' '), CASE WHEN p_size % 2 = 0 THEN [p_type] ELSE [] END),
                    CASE WHEN p_size % 5 = 0 THEN [p_brand] ELSE [] END) AS genres,
        TIMESTAMP '2023-12-01' + to_days(CAST(p_partkey % 30 AS INTEGER)) AS event_timestamp, p_size, p_type FROM part""",
    ),
    "movie_rows": (
        ["movie_base"],
        """SELECT movie_id, title, genres, event_timestamp, p_size FROM movie_base UNION ALL
        SELECT movie_id, title, list_prepend(p_type, genres), event_timestamp + INTERVAL 1 DAY, p_size
        FROM movie_base WHERE p_size % 3 = 0""",
    ),
    "movies": (
        ["movie_rows"],
        """SELECT * FROM movie_rows
        QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY event_timestamp DESC) = 1""",
    ),
    "movie_features": (
        ["movies"],
        f"""SELECT movie_id, row_number() OVER (ORDER BY movie_id) AS internal_movie_id, event_timestamp,
        {genre_sql(0)} AS genre_idx_0, {genre_sql(1)} AS genre_idx_1, {genre_sql(2)} AS genre_idx_2 FROM movies""",
    ),
    "users": (
        [],
        """SELECT c_custkey AS user_id,
        CASE WHEN c_acctbal < 0 THEN 'F' WHEN c_custkey % 7 = 0 THEN ' f ' WHEN c_custkey % 11 = 5 THEN '?' ELSE 'M' END AS gender,
        [1, 18, 25, 35, 45, 50, 56][c_nationkey % 7 + 1] AS age, c_nationkey % 21 AS occupation,
        TIMESTAMP '2023-12-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS event_timestamp FROM customer""",
    ),
    "user_rows": (
        ["users"],
        """SELECT * FROM users UNION ALL
        SELECT user_id, gender, age, occupation + 1, event_timestamp + INTERVAL 1 DAY FROM users WHERE user_id % 2 = 0""",
    ),
    "encoded_users": (
        ["user_rows"],
        """SELECT user_id, event_timestamp,
        CASE upper(trim(gender)) WHEN 'F' THEN 0 WHEN 'M' THEN 1 END AS gender_idx,
        CASE age WHEN 1 THEN 0 WHEN 18 THEN 1 WHEN 25 THEN 2 WHEN 35 THEN 3 WHEN 45 THEN 4 WHEN 50 THEN 5 ELSE 6 END AS age_idx,
        occupation FROM user_rows""",
    ),
    "profiles": (
        ["encoded_users"],
        """SELECT * FROM encoded_users
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) = 1""",
    ),
    "sequence_events": (
        ["ratings", "movie_features"],
        f"""SELECT user_id, internal_movie_id AS item, [genre_idx_0, genre_idx_1, genre_idx_2] AS genres,
        {SLOT_SQL} AS slot, rating_timestamp, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY rating_timestamp, event_id) AS pos,
        count(*) OVER (PARTITION BY user_id) AS n
        FROM ratings JOIN movie_features USING (movie_id) WHERE rating >= 3""",
    ),
    "sequence_events_big": (
        ["ratings_big", "movie_features"],
        f"""SELECT user_id, internal_movie_id AS item, [genre_idx_0, genre_idx_1, genre_idx_2] AS genres,
        {SLOT_SQL} AS slot, rating_timestamp,
        row_number() OVER (PARTITION BY user_id ORDER BY rating_timestamp, l_orderkey, l_linenumber, l_suppkey, movie_id) AS pos,
        count(*) OVER (PARTITION BY user_id) AS n
        FROM ratings_big JOIN movie_features USING (movie_id) WHERE rating >= 3""",
    ),
    "vector_index": (
        [],
        "SELECT vec_id AS movie_id, row_number() OVER (ORDER BY vec_id) AS item_idx FROM embeddings",
    ),
    "item_vectors": (
        ["vector_index"],
        """SELECT item_idx AS item, CAST(embedding AS DOUBLE[]) AS vec
        FROM embeddings JOIN vector_index ON vec_id = movie_id""",
    ),
    "some_vectors": (["item_vectors"], "SELECT * FROM item_vectors WHERE item % 7 <> 0"),
    "vector_events": (
        ["ratings", "vector_index"],
        f"""SELECT user_id, item_idx AS item, [] AS genres, {SLOT_SQL} AS slot, rating_timestamp, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY rating_timestamp, event_id) AS pos,
        count(*) OVER (PARTITION BY user_id) AS n
        FROM ratings JOIN vector_index USING (movie_id) WHERE rating >= 3""",
    ),
    "log": (
        [],
        """SELECT event_id, ts, user_id, value AS latency, value / 100 AS prediction, event_type = 'error' AS is_error,
        event_type AS label, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events""",
    ),
}


def samples_cte(events: str, cap: int | None = None) -> str:
    """Samples with their histories over one of the ``*_events`` CTEs."""
    limit = "" if cap is None else f" AND pos > n - 2 - {cap}"
    frame = "OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)"
    return f"""SELECT user_id, CASE WHEN pos = n THEN 'test' WHEN pos = n - 1 THEN 'val' ELSE 'train' END AS split,
        CAST(n - pos + 1 AS INTEGER) AS from_end, item_seq, genre_seq, time_seq, target, target_time, last_timestamp
        FROM (SELECT user_id, pos, n, list(item) {frame} AS item_seq, list(genres) {frame} AS genre_seq,
                     list(slot) {frame} AS time_seq, item AS target, slot AS target_time, rating_timestamp AS last_timestamp
              FROM {events}) WHERE n >= 5 AND pos >= 2{limit}"""


_CTES["raw_samples"] = (["sequence_events"], samples_cte("sequence_events"))
_CTES["samples"] = (
    ["raw_samples", "profiles"],
    """SELECT s.*, p.age_idx, p.gender_idx, p.occupation FROM raw_samples s JOIN profiles p USING (user_id)
    WHERE p.age_idx IS NOT NULL AND p.gender_idx IS NOT NULL AND p.occupation IS NOT NULL""",
)
_CTES["capped_samples"] = (["samples"], f"SELECT * FROM samples WHERE from_end <= {FIT_POSITIONS + 2}")
_CTES["staged"] = (
    ["samples"],
    """SELECT user_id, CAST(to_timestamp(last_timestamp) AT TIME ZONE 'UTC' AS TIMESTAMP) AS event_timestamp,
    gender_idx, age_idx, occupation, target, target_time FROM samples""",
)
_CTES["fit_rows"] = (["capped_samples"], _CTES["staged"][1].replace("FROM samples", "FROM capped_samples"))
_CTES["vector_samples"] = (["vector_events"], samples_cte("vector_events"))


def with_bindings(sql: str, *names: str) -> str:
    """``sql`` behind the CTEs ``names`` and everything they are built on."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            needs, body = _CTES[name]
            for n in needs:
                add(n)
            done[name] = body

    for name in names:
        add(name)
    ctes = [f"{n} AS ({body})" for n, body in done.items()]
    if sql.lstrip().upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + sql.lstrip()[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
