"""Encodings, dense indices, feature tables and feature lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import encode
from seqloom.functions.vocab import FEATURE_COLS
from seqloom.operators import clean, features, index, sequences
from seqloom.plans.bindings import (
    ORDER_VALUE,
    PART_GENRES,
    PROFILE_VIEW,
    SAMPLE_VIEW,
    SLOT_SQL,
    VIEW_VALUE,
    Tables,
    genre_sql,
)
from seqloom.plans.registry import as_text, query
from seqloom.session import scratch_path
from seqloom.streaming import buckets


def _sec() -> Column:
    return F.unix_seconds("event_timestamp").alias("event_sec")


_SEC_SQL = "CAST(epoch(event_timestamp) AS BIGINT) AS event_sec"
_AGE_SQL = "CASE age WHEN 1 THEN 0 WHEN 18 THEN 1 WHEN 25 THEN 2 WHEN 35 THEN 3 WHEN 45 THEN 4 WHEN 50 THEN 5 ELSE 6 END"


@query(
    f"""SELECT user_id, {_SEC_SQL}, CASE gender WHEN 'F' THEN 0 ELSE 1 END AS gender_idx, {_AGE_SQL} AS age_idx FROM user_rows""",
    "user_rows",
)
def encode_user_fixed(t: Tables) -> DataFrame:
    gender, age = encode.gender_code_strict(F.col("gender")), encode.age_bucket(F.col("age"))
    return t.user_rows.select("user_id", _sec(), gender.alias("gender_idx"), age.alias("age_idx"))


@query(
    f"""SELECT user_id, {_SEC_SQL}, CASE upper(trim(gender)) WHEN 'F' THEN 0 WHEN 'M' THEN 1 END AS gender_idx FROM user_rows""",
    "user_rows",
)
def encode_user_label(t: Tables) -> DataFrame:
    return t.user_rows.select("user_id", _sec(), encode.gender_code(F.col("gender")).alias("gender_idx"))


@query(
    f"""SELECT user_id, {_SEC_SQL}, age, CAST(dense_rank() OVER (ORDER BY age) - 1 AS INTEGER) AS age_idx FROM user_rows""",
    "user_rows",
)
def label_encode(t: Tables) -> DataFrame:
    return index.label_encode(t.user_rows.select("user_id", _sec(), "age"), "age", "age_idx")


@query(f"SELECT movie_id, {_SEC_SQL}, {', '.join(f'{genre_sql(k)} AS g{k}' for k in range(3))} FROM movie_rows", "movie_rows")
def encode_genres(t: Tables) -> DataFrame:
    codes = t.movie_rows.select("movie_id", _sec(), encode.genre_codes(F.col("genres"), PART_GENRES).alias("g"))
    return codes.select("movie_id", "event_sec", *[F.get("g", F.lit(k)).alias(f"g{k}") for k in range(3)])


@query(
    f"""SELECT movie_id, {_SEC_SQL}, {', '.join(f'{genre_sql(k)} AS g{k}' for k in range(3))} FROM movie_rows""",
    "movie_rows",
)
def parse_encode_genres(t: Tables) -> DataFrame:
    """The genre lists as text with pipes or spaces and, on some rows, a leading blank."""
    piped = F.concat(F.when(F.col("p_size") % 7 == 0, " ").otherwise(""), F.array_join("genres", "|"))
    spaced = F.concat(F.when(F.col("p_size") % 7 == 0, " ").otherwise(""), F.array_join("genres", " "))
    text = t.movie_rows.withColumn("text", F.when(F.col("p_size") % 3 == 0, piped).otherwise(spaced))
    codes = encode.genre_codes(encode.split_genres(F.col("text")), PART_GENRES)
    return text.select("movie_id", _sec(), codes.alias("g")).select(
        "movie_id", "event_sec", *[F.get("g", F.lit(k)).alias(f"g{k}") for k in range(3)]
    )


@query(f"SELECT * EXCLUDE (event_timestamp), {_SEC_SQL} FROM movie_features", "movie_features")
def movie_features(t: Tables) -> DataFrame:
    return t.movie_features.withColumn("event_sec", _sec()).drop("event_timestamp")


@query(f"SELECT event_id, {SLOT_SQL} AS time_slot FROM ratings", "ratings")
def time_slot(t: Tables) -> DataFrame:
    return t.ratings.select("event_id", encode.time_slot(F.col("rating_timestamp")).alias("time_slot"))


@query(
    """SELECT movie_id, coalesce(title, 'Movie ' || movie_id) AS title, array_to_string(genres, '|') AS genres FROM movies""",
    "movies",
)
def item_catalog(t: Tables) -> DataFrame:
    return t.movies.select(
        "movie_id",
        encode.title_or_default(F.col("title"), F.col("movie_id")).alias("title"),
        encode.genre_text(F.col("genres")).alias("genres"),
    )


@query(
    f"""SELECT r.event_id, user_id, movie_id, rating, u.gender, u.age, u.occupation,
    {', '.join(f'{genre_sql(k, "m.genres")} AS g{k}' for k in range(3))}
    FROM ratings r JOIN users u USING (user_id) JOIN movies m USING (movie_id)""",
    "ratings",
    "users",
    "movies",
)
def rating_user_movie_join(t: Tables) -> DataFrame:
    codes = t.movies.select("movie_id", encode.genre_codes(F.col("genres"), PART_GENRES).alias("g"))
    joined = t.ratings.join(t.users.drop("event_timestamp"), "user_id").join(codes, "movie_id")
    return joined.select(
        "event_id", "user_id", "movie_id", "rating", "gender", "age", "occupation", *[F.get("g", F.lit(k)).alias(f"g{k}") for k in range(3)]
    )


@query(
    f"""SELECT event_id, user_id, internal_movie_id, CAST(rating AS FLOAT) AS rating, {SLOT_SQL} AS time_slot
    FROM ratings JOIN movie_features USING (movie_id) WHERE rating >= 3""",
    "ratings",
    "movie_features",
)
def rating_events(t: Tables) -> DataFrame:
    return t.rating_events.select("event_id", "user_id", "internal_movie_id", "rating", "time_slot")


@query(
    f"""SELECT event_id, user_id, internal_movie_id, {SLOT_SQL} AS time_slot, gender_idx, age_idx, p.occupation
    FROM ratings JOIN movie_features USING (movie_id) JOIN profiles p USING (user_id)
    WHERE rating >= 3 AND gender_idx IS NOT NULL AND age_idx IS NOT NULL AND p.occupation IS NOT NULL""",
    "ratings",
    "movie_features",
    "profiles",
)
def training_features(t: Tables) -> DataFrame:
    joined = features.training_features(t.rating_events.drop("event_timestamp"), t.encoded_users, PROFILE_VIEW)
    return joined.select(
        "event_id", "user_id", "internal_movie_id", "time_slot", "gender_idx", "age_idx", "occupation"
    )


@query(
    """SELECT event_id, internal_movie_id, CASE WHEN movie_id IS NULL THEN '[0,0,0]' ELSE CAST(to_json([genre_idx_0, genre_idx_1, genre_idx_2]) AS VARCHAR) END AS genres
    FROM (SELECT event_id, movie_id + 1 AS internal_movie_id FROM ratings)
    LEFT JOIN movie_features USING (internal_movie_id)""",
    "ratings",
    "movie_features",
)
def history_genres(t: Tables) -> DataFrame:
    events = t.ratings.select("event_id", (F.col("movie_id") + 1).alias("internal_movie_id"))
    joined = sequences.history_genres(events, t.movie_features)
    return joined.withColumn("genres", as_text("genres"))


@query("SELECT event_id, movie_id, movie_id_idx FROM ratings JOIN (SELECT p_partkey AS movie_id, row_number() OVER (ORDER BY p_partkey) AS movie_id_idx FROM part) USING (movie_id)", "ratings")
def dense_item_index(t: Tables) -> DataFrame:
    """Index over all movies applied to the ratings."""
    idx = index.dense_index(t.movie_rows, "movie_id", "movie_id_idx")
    return index.apply_index(t.ratings.select("event_id", "movie_id"), idx, "movie_id")


@query(
    """SELECT event_id, movie_id, CAST(dense_rank() OVER (ORDER BY movie_id) AS BIGINT) AS item_idx
    FROM ratings JOIN movies USING (movie_id) WHERE rating >= 3""",
    "ratings",
    "movies",
)
def dense_item_index_observed(t: Tables) -> DataFrame:
    """Index over the movies that are left after joins and the positive filter."""
    seen = clean.positive_interactions(t.ratings).join(t.movies.select("movie_id"), "movie_id", "left_semi")
    return index.apply_index(seen.select("event_id", "movie_id"), index.dense_index(seen, "movie_id"), "movie_id")


@query(
    """SELECT 'forward' AS direction, movie_id AS from_id, internal_movie_id AS to_id FROM movie_features
    UNION ALL SELECT 'reverse', internal_movie_id, movie_id FROM movie_features""",
    "movie_features",
)
def item_id_map(t: Tables) -> DataFrame:
    idx = index.dense_index(t.movie_rows, "movie_id", "internal_movie_id")
    return index.reverse_index(idx, "movie_id", "internal_movie_id")


@query(
    f"""SELECT user_id, CAST(epoch(max(event_timestamp)) AS BIGINT) AS event_sec,
    CASE gender WHEN 'F' THEN 0 ELSE 1 END AS gender_idx, {_AGE_SQL} AS age_idx, CAST(occupation AS INTEGER) AS occupation
    FROM user_rows GROUP BY user_id, gender, age, occupation""",
    "user_rows",
)
def user_features(t: Tables) -> DataFrame:
    return features.user_features(t.user_rows).withColumn("event_sec", _sec()).drop("event_timestamp")


@query(
    """SELECT movie_id, CAST(to_json(genres) AS VARCHAR) AS genres, CAST(epoch(max(event_timestamp)) AS BIGINT) AS event_sec
    FROM movie_rows GROUP BY movie_id, genres""",
    "movie_rows",
)
def movie_versions(t: Tables) -> DataFrame:
    return features.movie_versions(t.movie_rows).select("movie_id", as_text("genres").alias("genres"), _sec())


@query(
    """SELECT (SELECT count(DISTINCT movie_id) + 1 FROM movie_rows) AS num_items, 19 AS num_genres, 7 AS num_ages, 2 AS num_genders,
    greatest(21, max(occupation) + 1) AS num_occupations, 3 AS num_time_slots, 3 AS max_genres_per_item,
    count(DISTINCT user_id) AS num_users FROM user_rows""",
    "user_rows",
    "movie_rows",
)
def vocabulary_sizes(t: Tables) -> DataFrame:
    return features.vocabulary_sizes(t.user_rows, t.movie_rows, len(PART_GENRES))


@query(
    f"""SELECT time_slot, count(event_id) AS ratings FROM (SELECT unnest([0, 1, 2]) AS time_slot)
    LEFT JOIN (SELECT event_id, {SLOT_SQL} AS time_slot FROM ratings) USING (time_slot) GROUP BY time_slot""",
    "ratings",
)
def time_slot_distribution(t: Tables) -> DataFrame:
    return features.time_slot_distribution(t.ratings)


@query(
    f"""SELECT user_id, {_SEC_SQL}, gender, age, CAST(occupation AS INTEGER) AS occupation FROM user_rows
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) = 1""",
    "user_rows",
)
def latest_features(t: Tables) -> DataFrame:
    latest = features.latest_per_key(t.user_rows.drop("version"), ["user_id"], ["event_timestamp"])
    return latest.withColumn("event_sec", _sec()).drop("event_timestamp")


_WINDOW_END = "2023-12-24 00:00:00"


@query(
    f"""SELECT user_id, {_SEC_SQL}, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation FROM encoded_users
    WHERE event_timestamp BETWEEN TIMESTAMP '{_WINDOW_END}' - INTERVAL 7 DAY AND TIMESTAMP '{_WINDOW_END}'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) = 1""",
    "encoded_users",
)
def materialize_window(t: Tables) -> DataFrame:
    rows = features.materialize_window(t.encoded_users, PROFILE_VIEW, _WINDOW_END)
    return rows.withColumn("event_sec", _sec()).drop("event_timestamp")


def _purchases(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")


def _orders(t: Tables) -> DataFrame:
    return t.read("orders").select(
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 25 YEARS")).cast("timestamp").alias("ts"),
        "o_totalprice",
        "o_orderkey",
    )


def _views(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'view'").select("event_id", "user_id", "ts", "value")


_PIT_SQL = """WITH pit AS (SELECT e.event_id, e.user_id, e.ts, CASE WHEN f.ts >= e.ts - INTERVAL 3 DAY THEN f.value END AS seen__value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') e
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') f ON e.user_id = f.user_id AND e.ts >= f.ts)"""


@query(f"{_PIT_SQL} SELECT event_id, user_id, seen__value FROM pit")
def pit_join(t: Tables) -> DataFrame:
    joined = features.point_in_time_join(_purchases(t), "user_id", "ts", [(_views(t), VIEW_VALUE)])
    return joined.select("event_id", "user_id", "seen__value")


@query(
    f"""{_PIT_SQL}, spend AS (
        SELECT o_custkey, o_orderdate + INTERVAL 25 YEAR AS ts, max_by(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY ALL)
    SELECT event_id, user_id, seen__value, CASE WHEN s.ts >= pit.ts - INTERVAL 365 DAY THEN s.o_totalprice END AS spend__o_totalprice
    FROM pit ASOF LEFT JOIN spend s ON pit.user_id = s.o_custkey AND pit.ts >= s.ts"""
)
def pit_join_multi_view(t: Tables) -> DataFrame:
    joined = features.point_in_time_join(
        _purchases(t), "user_id", "ts", [(_views(t), VIEW_VALUE), (_orders(t), ORDER_VALUE)]
    )
    return joined.select("event_id", "user_id", "seen__value", "spend__o_totalprice")


@query(
    """WITH spine AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN user_id END AS user_id, ts FROM events),
    spend AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey, o_orderdate + INTERVAL 25 YEAR AS ts,
        max_by(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY ALL)
    SELECT event_id, spine.user_id, CASE WHEN s.ts >= spine.ts - INTERVAL 365 DAY THEN s.o_totalprice END AS spend__o_totalprice
    FROM spine ASOF LEFT JOIN spend s ON spine.user_id = s.o_custkey AND spine.ts >= s.ts"""
)
def pit_join_orders(t: Tables) -> DataFrame:
    """All events against all orders; users that are not known, on either side, match nothing."""
    events = t.events.select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("user_id"), "ts")
    orders = _orders(t).withColumn("user_id", F.when(F.col("o_orderkey") % 50 != 0, F.col("user_id")))
    joined = features.point_in_time_join(events, "user_id", "ts", [(orders, ORDER_VALUE)])
    return joined.select("event_id", "user_id", "spend__o_totalprice")


_ONLINE_END = "2024-01-28 00:00:00"


def _requests(t: Tables) -> DataFrame:
    """Every customer, every tenth once more, and an id that no customer has for every supplier; ``ord`` is the order."""
    key, supplier = F.col("c_custkey"), F.col("s_suppkey")
    times = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1_000_000_000))
    again = t.read("customer").select(key, F.explode(F.when(key % 10 == 0, times[1]).otherwise(times[0])).alias("at"))
    known = again.select((key + F.col("at")).alias("ord"), key.alias("user_id"))
    unknown = t.read("supplier").select((-1 - supplier).alias("ord"), (-1 - supplier).alias("user_id"))
    return known.unionByName(unknown)


def _online(t: Tables) -> DataFrame:
    return features.materialize_window(t.staged_table, SAMPLE_VIEW, _ONLINE_END)


_ONLINE_SQL = f"""requests AS (SELECT c_custkey AS ord, c_custkey AS user_id FROM customer
        UNION ALL SELECT c_custkey + 1000000000, c_custkey FROM customer WHERE c_custkey % 10 = 0
        UNION ALL SELECT -1 - s_suppkey, -1 - s_suppkey FROM supplier),
    online AS (SELECT * FROM staged WHERE event_timestamp BETWEEN TIMESTAMP '{_ONLINE_END}' - INTERVAL 7 DAY AND TIMESTAMP '{_ONLINE_END}'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, target DESC) = 1)"""


@query(
    f"""WITH {_ONLINE_SQL} SELECT ord, user_id, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation, target_time,
    gender_idx IS NULL AND age_idx IS NULL AND occupation IS NULL AND target_time IS NULL AS is_miss
    FROM requests LEFT JOIN online USING (user_id)""",
    "staged",
)
def online_lookup(t: Tables) -> DataFrame:
    return features.online_lookup(_requests(t), _online(t))


@query(
    f"""WITH {_ONLINE_SQL} SELECT ord, user_id, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation, target_time,
    gender_idx IS NULL AND age_idx IS NULL AND occupation IS NULL AND target_time IS NULL AS is_miss
    FROM requests LEFT JOIN online USING (user_id)""",
    "staged",
)
def bucket_online_lookup(t: Tables) -> DataFrame:
    """The same requests from a table in hash buckets, to which the rows came in two halves, the older ones last."""
    root, order = scratch_path(t.spark, "buckets"), [SAMPLE_VIEW.time, *SAMPLE_VIEW.tie]
    online, requests = _online(t), _requests(t)
    even = F.pmod(F.col("user_id"), F.lit(2)) == 0
    buckets.upsert(online.where(even), root, ["user_id"], order, buckets=32)
    late = online.where(even).withColumn(SAMPLE_VIEW.time, F.col(SAMPLE_VIEW.time) - F.expr("INTERVAL 1 DAY"))
    buckets.upsert(online.where(~even).unionByName(late.withColumn("gender_idx", F.lit(9))), root, ["user_id"], order)
    return features.online_lookup(requests, buckets.rows_of(requests, root, ["user_id"]))


@query(
    f"""WITH {_ONLINE_SQL}, offline AS (SELECT * FROM staged
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, target DESC) = 1)
    SELECT r.ord, r.user_id, coalesce(o.gender_idx, f.gender_idx) AS gender_idx, coalesce(o.age_idx, f.age_idx) AS age_idx,
    CAST(coalesce(o.occupation, f.occupation) AS INTEGER) AS occupation, coalesce(o.target_time, f.target_time) AS target_time,
    CASE WHEN o.user_id IS NOT NULL THEN 'online' WHEN f.user_id IS NOT NULL THEN 'offline' ELSE 'missing' END AS feature_source
    FROM requests r LEFT JOIN online o USING (user_id) LEFT JOIN offline f USING (user_id)""",
    "staged",
)
def online_lookup_with_fallback(t: Tables) -> DataFrame:
    return features.online_lookup_with_fallback(
        _requests(t), _online(t), t.staged_table, [SAMPLE_VIEW.time, *SAMPLE_VIEW.tie]
    )


@query(
    f"""WITH {_ONLINE_SQL}, offline AS (SELECT * FROM staged
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, target DESC) = 1),
    filled AS (SELECT * FROM online UNION ALL
        SELECT * FROM offline WHERE user_id IN (SELECT user_id FROM requests) AND user_id NOT IN (SELECT user_id FROM online))
    SELECT user_id, {_SEC_SQL}, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation, target_time, target FROM filled""",
    "staged",
)
def online_write_back(t: Tables) -> DataFrame:
    """The online table after the rows that a lookup missed were written back."""
    online, order = _online(t), [SAMPLE_VIEW.time, *SAMPLE_VIEW.tie]
    missed = features.newest_missed(features.online_lookup(_requests(t), online), t.staged_table, order)
    merged = features.online_upsert(online, missed, "user_id", order)
    return merged.withColumn("event_sec", _sec()).drop("event_timestamp")


@query(
    f"""SELECT user_id, {_SEC_SQL}, gender, age, CAST(occupation AS INTEGER) AS occupation FROM user_rows
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) = 1""",
    "user_rows",
)
def online_upsert(t: Tables) -> DataFrame:
    """The first versions as the table, the second versions as what is written to it."""
    later = t.user_rows.where("version = 1").drop("version")
    merged = features.online_upsert(t.users, later, "user_id", ["event_timestamp"])
    return merged.withColumn("event_sec", _sec()).drop("event_timestamp")


@query(
    f"""WITH {_ONLINE_SQL}, looked AS (SELECT * FROM requests LEFT JOIN online USING (user_id))
    {' UNION ALL '.join(f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS missing_rate FROM looked" for c in FEATURE_COLS)}""",
    "staged",
)
def feature_missing_rate(t: Tables) -> DataFrame:
    return features.feature_missing_rate(features.online_lookup(_requests(t), _online(t)), FEATURE_COLS)
