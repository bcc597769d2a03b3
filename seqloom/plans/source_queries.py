"""Parsing, event messages and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import encode
from seqloom.operators import clean, contract
from seqloom.plans.bindings import PROFILE_VIEW, SERVICE, Tables
from seqloom.operators.features import select_service
from seqloom.plans.registry import as_text, query
from seqloom.session import scratch_path
from seqloom.sources import delimited, events, tables, versions


def _lines(df: DataFrame, fields: list[Column], key: str) -> DataFrame:
    """Delimited text of a table in which every 50th line has lost its last field."""
    whole = F.concat_ws("::", *fields)
    short = F.concat_ws("::", *fields[:-1])
    return df.select(F.when(F.col(key) % 50 == 49, short).otherwise(whole).alias("value"))


def _text(*columns: str) -> list[Column]:
    return [F.col(c).cast("string") for c in columns]


@query(
    """SELECT user_id, gender, age, CAST(occupation AS INTEGER) AS occupation, '94' || user_id AS zip_code
    FROM user_rows WHERE user_id % 50 <> 49""",
    "user_rows",
)
def parse_delimited_users(t: Tables) -> DataFrame:
    zipped = t.user_rows.withColumn("zip_code", F.concat(F.lit("94"), F.col("user_id").cast("string")))
    fields = _text("user_id", "gender", "age", "occupation", "zip_code")
    return delimited.parse_users(_lines(zipped, fields, "user_id"))


@query(
    "SELECT movie_id, title, CAST(to_json(genres) AS VARCHAR) AS genres FROM movies WHERE movie_id % 50 <> 49", "movies"
)
def parse_delimited_movies(t: Tables) -> DataFrame:
    fields = [*_text("movie_id", "title"), F.array_join("genres", "|")]
    return delimited.parse_movies(_lines(t.movies, fields, "movie_id")).withColumn("genres", as_text("genres"))


@query(
    """SELECT user_id, movie_id, CAST(rating AS INTEGER) AS rating, rating_timestamp
    FROM ratings WHERE event_id % 50 <> 49""",
    "ratings",
)
def parse_delimited_ratings(t: Tables) -> DataFrame:
    fields = _text("user_id", "movie_id", "rating", "rating_timestamp")
    return delimited.parse_ratings(_lines(t.ratings, fields, "event_id"))


@query(
    """SELECT 'new-rating' AS topic, user_id || '-' || movie_id AS key,
    '{"user_id":' || user_id || ',"movie_id":' || movie_id || ',"rating":' || rating || ',"rating_timestamp":' || rating_timestamp || '}' AS value
    FROM ratings""",
    "ratings",
)
def encode_events(t: Tables) -> DataFrame:
    columns = ["user_id", "movie_id", "rating", "rating_timestamp"]
    return events.encode_events(t.ratings, ["user_id", "movie_id"], "new-rating", columns)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS id, epoch_us(ts) AS event_us, json_extract_string(props, '$.k') AS payload_k
    FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0"""
)
def validate_events(t: Tables) -> DataFrame:
    valid = events.validate_events(t.messages)
    return valid.select(
        "id", F.unix_micros(F.to_timestamp("timestamp")).alias("event_us"), F.col("payload")["k"].alias("payload_k")
    )


@query(
    """SELECT topic, count(*) AS messages FROM (
        SELECT CASE event_id % 4 WHEN 0 THEN 'raw-events' WHEN 1 THEN 'new-user' WHEN 2 THEN 'new-movie' ELSE 'new-rating' END AS topic
        FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0) GROUP BY topic"""
)
def quarantine_events(t: Tables) -> DataFrame:
    return events.quarantine_events(t.messages).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query(
    """SELECT CASE event_id % 4 WHEN 0 THEN 'raw_events' WHEN 1 THEN 'new_user' WHEN 2 THEN 'new_movie' ELSE 'new_rating' END AS table_name,
    count(*) AS accepted FROM events GROUP BY 1"""
)
def route_topics(t: Tables) -> DataFrame:
    accepted = events.accepted_per_topic(t.messages)
    return accepted.select(events.table_name(F.col("topic")).alias("table_name"), "accepted")


def _timed(t: Tables) -> DataFrame:
    decoded = events.parse_value(t.messages, events.ENVELOPE).select(
        F.col("key").alias("id"), F.col("event.timestamp"), (F.date_trunc("day", "ts")).alias("event_timestamp")
    )
    return events.derive_event_time(decoded)


@query(
    """SELECT CAST(event_id AS VARCHAR) AS id,
    epoch_us(CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN date_trunc('day', ts) ELSE ts END) AS event_us FROM events"""
)
def derive_event_time(t: Tables) -> DataFrame:
    return _timed(t).select("id", F.unix_micros("event_timestamp").alias("event_us"))


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS row_count
    FROM events GROUP BY ALL"""
)
def partition_event_counts(t: Tables) -> DataFrame:
    """Through the partitioned raw table: written by date and counted from the directory columns."""
    path = scratch_path(t.spark, "raw_events")
    events.append_raw(_timed(t), path)
    schema = "id string, timestamp string, event_timestamp timestamp, year string, month string, day string"
    raw = t.spark.read.schema(schema).parquet(path)
    return raw.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT user_id, event_type, value FROM events")
def scan_project(t: Tables) -> DataFrame:
    return tables.scan_project(t.spark, t.path("events"), ["user_id", "event_type", "value"])


@query(
    """SELECT user_id, CAST(epoch(event_timestamp) AS BIGINT) AS event_sec, gender_idx, age_idx,
    CAST(occupation AS INTEGER) AS occupation, target, target_time FROM staged""",
    "staged",
)
def staging_projection(t: Tables) -> DataFrame:
    rows = t.staged_samples
    return rows.select(F.unix_seconds("event_timestamp").alias("event_sec"), *[c for c in rows.columns if c != "event_timestamp"])


@query(
    """SELECT c_custkey AS user_id, CAST(c_acctbal AS DOUBLE) AS balance, TRY_CAST(c_name AS BIGINT) AS name_number,
    TRY_CAST(substr(c_name, 10) AS BIGINT) AS name_suffix FROM customer"""
)
def coerce_numeric(t: Tables) -> DataFrame:
    raw = t.read("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.col("c_name").alias("name_number"),
        F.substring("c_name", 10, 20).alias("name_suffix"),
    )
    return clean.coerce_numeric(raw, {"balance": "double", "name_number": "bigint", "name_suffix": "bigint"})


@query(
    """SELECT user_id, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation FROM encoded_users
    WHERE user_id IS NOT NULL AND gender_idx IS NOT NULL""",
    "encoded_users",
)
def drop_null_keys(t: Tables) -> DataFrame:
    return clean.drop_null_keys(t.encoded_users, ["user_id", "gender_idx"]).drop("event_timestamp")


@query(
    """SELECT user_id, CAST(occupation AS INTEGER) AS occupation FROM user_rows
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp) = 1""",
    "user_rows",
)
def dedup_by_key(t: Tables) -> DataFrame:
    kept = clean.dedup_by_key(t.user_rows, ["user_id"], [F.col("event_timestamp").asc()])
    return kept.select("user_id", "occupation")


@query("SELECT event_id, user_id, movie_id, CAST(rating AS INTEGER) AS rating FROM ratings WHERE rating >= 3", "ratings")
def positive_interactions(t: Tables) -> DataFrame:
    return clean.positive_interactions(t.ratings).select("event_id", "user_id", "movie_id", "rating")


@query("SELECT user_id, epoch_us(event_timestamp) AS event_us FROM ratings", "ratings")
def entity_frame(t: Tables) -> DataFrame:
    return clean.entity_frame(t.ratings).select("user_id", F.unix_micros("event_timestamp").alias("event_us"))


@query(
    """SELECT user_id, CAST(occupation AS INTEGER) AS occupation, CAST(epoch(event_timestamp) AS BIGINT) AS event_sec
    FROM user_rows WHERE user_id IN (SELECT user_id FROM events)""",
    "user_rows",
)
def entity_semi_filter(t: Tables) -> DataFrame:
    rows = clean.restrict_to_entities(t.user_rows, t.events)
    return rows.select("user_id", "occupation", F.unix_seconds("event_timestamp").alias("event_sec"))


@query(
    """SELECT user_id, last_timestamp AS event_sec, CAST(to_json(item_seq) AS VARCHAR) AS item_seq,
    CAST(to_json(genre_seq) AS VARCHAR) AS genre_seq,
    CAST(to_json(time_seq) AS VARCHAR) AS time_seq, target, target_time, age_idx, gender_idx, CAST(occupation AS INTEGER) AS occupation
    FROM samples""",
    "samples",
)
def flatten_samples(t: Tables) -> DataFrame:
    rows = clean.flatten_samples(t.samples)
    return rows.withColumns(
        {"item_seq": as_text("item_seq"), "time_seq": as_text("time_seq"), "genre_seq": as_text("genre_seq")}
    ).select(F.unix_seconds("event_timestamp").alias("event_sec"), *[c for c in rows.columns if c != "event_timestamp"])


@query(
    "SELECT user_id, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation, target_time, target FROM staged",
    "staged",
)
def feature_service_projection(t: Tables) -> DataFrame:
    return select_service(t.staged_samples, SERVICE, ["user_id", "target"])


@query(
    """SELECT c_custkey AS id, 'customer' AS source, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, 'supplier', s_nationkey, NULL FROM supplier"""
)
def union_sources(t: Tables) -> DataFrame:
    customers = t.read("customer").select(
        F.col("c_custkey").alias("id"),
        F.lit("customer").alias("source"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.read("supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source")
    )
    return clean.union_sources(customers, suppliers)


@query("SELECT event_id, user_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def first_rows(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "event_type", "value", (-F.col("value")).alias("_by"))
    return clean.first_rows(rows, ["_by", "event_id"], 10).drop("_by")


@query(
    """SELECT p_partkey, CASE WHEN hi > lo THEN (p_retailprice - lo) / (hi - lo) ELSE p_retailprice END AS p_retailprice,
    CASE WHEN shi > slo THEN (p_size - slo) / CAST(shi - slo AS DOUBLE) ELSE p_size END AS p_size, 7.0::DOUBLE AS same
    FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi, min(p_size) AS slo, max(p_size) AS shi FROM part)"""
)
def minmax_normalize(t: Tables) -> DataFrame:
    rows = t.read("part").select(
        "p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"), F.lit(7.0).alias("same")
    )
    return clean.minmax_normalize(rows, ["p_retailprice", "p_size", "same"])


@query("SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events")
def extract_hour(t: Tables) -> DataFrame:
    as_written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select("event_id", encode.hour_of(as_written).alias("hour"))


_RULES = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM checked"
    for rule, broken in {
        **{
            f"{c}_not_null": f"{c} IS NULL"
            for c in ("user_id", "gender_idx", "age_idx", "occupation", "target", "target_time")
        },
        "gender_idx_in_0_1": "gender_idx NOT IN (0, 1)",
        "age_idx_not_negative": "age_idx < 0",
        "target_at_least_1": "target < 1",
        "target_time_in_0_1_2": "target_time NOT IN (0, 1, 2)",
    }.items()
)


@query(
    f"""WITH checked AS (SELECT user_id, p.gender_idx, p.age_idx, p.occupation, movie_id AS target, rating - 1 AS target_time
    FROM ratings LEFT JOIN profiles p USING (user_id)) {_RULES}""",
    "ratings",
    "profiles",
)
def contract_violations(t: Tables) -> DataFrame:
    """The staged-row rules on unstaged rows, where some are broken."""
    unstaged = t.ratings.select("user_id", F.col("movie_id").alias("target"), (F.col("rating") - 1).alias("target_time"))
    return contract.contract_violations(
        unstaged.join(t.profiles.select("user_id", *PROFILE_VIEW.features), "user_id", "left")
    )


@query(
    """SELECT (SELECT count(*) FROM samples) AS source_rows, (SELECT count(*) FROM staged) AS staged_rows,
    (SELECT count(*) FROM samples) = (SELECT count(*) FROM staged) AS equal""",
    "staged",
)
def contract_row_counts(t: Tables) -> DataFrame:
    """Samples against what a reader finds in the staged files."""
    path = scratch_path(t.spark, "staged")
    tables.overwrite_table(t.staged_samples, path)
    return contract.contract_row_counts(t.samples, t.spark.read.parquet(path))


_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _NAMES))
def table_counts(t: Tables) -> DataFrame:
    return contract.table_counts({n: t.read(n) for n in _NAMES})


_BY_USER = "SELECT user_id, count(*) AS n, CAST(sum(rating) AS BIGINT) AS total FROM ratings GROUP BY user_id"


@query(_BY_USER, "ratings")
def stage_query(t: Tables) -> DataFrame:
    """A SELECT over named views, staged as files and read back."""
    tables.register_views({"ratings": t.ratings})
    path = scratch_path(t.spark, "staged-query")
    tables.stage_query(t.spark, _BY_USER, path)
    return t.spark.read.parquet(path)


@query("SELECT count(*) AS registered, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_orders FROM orders")
def register_table(t: Tables) -> DataFrame:
    """The order table under a name of its own: the count it was registered with, and a query on the name."""
    n = tables.register_table(t.spark, "registered_orders", t.path("orders"))
    named = t.spark.sql("SELECT count(*) AS open_orders FROM registered_orders WHERE o_orderstatus = 'O'")
    return named.select(F.lit(n).cast("long").alias("registered"), "open_orders")


@query("SELECT movie_id, title, CAST(to_json(genres) AS VARCHAR) AS genres FROM movies", "movies")
def document_round_trip(t: Tables) -> DataFrame:
    """The catalog written as JSON lines and read back."""
    rows = t.movies.select("movie_id", "title", "genres")
    path = scratch_path(t.spark, "catalog")
    tables.write_document(rows, path)
    return tables.read_document(t.spark, path, rows.schema).withColumn("genres", as_text("genres"))


@query("SELECT event_id, user_id, movie_id FROM ratings WHERE rating >= 3", "ratings")
def require_rows(t: Tables) -> DataFrame:
    """Passes what has rows; a table without rows is refused before anything is computed from it."""
    try:
        contract.require_rows(t.ratings.where("rating > 5"), "ratings above the scale")
    except ValueError:
        return contract.require_rows(clean.positive_interactions(t.ratings), "ratings").select(
            "event_id", "user_id", "movie_id"
        )
    raise AssertionError("an empty table was let through")


@query(
    """SELECT * FROM (
    SELECT 0::BIGINT AS version, 'overwrite' AS operation, 'event_id,user_id' AS columns, count(*) AS row_count, sum(event_id)::BIGINT AS total
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT 1, 'append', 'event_id,user_id', count(*), sum(event_id)::BIGINT FROM events
    UNION ALL SELECT 2, 'overwrite', 'event_type,user_id,value', count(*), sum(user_id)::BIGINT FROM events
    UNION ALL SELECT 3, 'append', 'event_type,user_id,value', 2 * count(*), 2 * sum(user_id)::BIGINT FROM events)"""
)
def overwrite_read_versions(t: Tables) -> DataFrame:
    """A table overwritten with its schema and added to; every version is read back, the old ones after the new."""
    root = scratch_path(t.spark, "versions")
    narrow, other = t.events.select("event_id", "user_id"), t.events.select("event_type", "user_id", "value")
    clicks = F.col("event_type") == "click"
    versions.overwrite(t.events.where(clicks).select(*narrow.columns), root)
    versions.append(t.events.where(~clicks | F.col("event_type").isNull()).select(*narrow.columns), root)
    versions.overwrite(other, root)
    versions.append(other, root)
    out = None
    for number in range(4):
        v = versions.current(t.spark, root, number)
        rows = versions.read(t.spark, root, number)
        part = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("event_id" if number < 2 else "user_id").alias("total")).select(
            F.lit(number).cast("long").alias("version"),
            F.lit(v.operation).alias("operation"),
            F.lit(",".join(rows.columns)).alias("columns"),
            "row_count",
            "total",
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS row_count,
    sum(event_id)::BIGINT AS total, true AS few_files FROM events GROUP BY ALL"""
)
def compact_raw_table(t: Tables) -> DataFrame:
    """The raw table of events after several loads over the same dates, compacted: the same rows, few files of a date."""
    root, loads = scratch_path(t.spark, "raw"), 4
    rows = events.add_date_partition(t.events.select("event_id", "user_id", "ts"), "ts")
    for k in range(loads):
        versions.append(rows.where(F.pmod(F.col("event_id"), F.lit(loads)) == k), root, ["year", "month", "day"])
    versions.compact(t.spark, root)
    dates = ["year", "month", "day"]
    file = F.col("_metadata.file_path").alias("file")
    by_file = versions.read(t.spark, root).groupBy(*dates, file, F.col("_metadata.file_size").alias("bytes"))
    by_file = by_file.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    # two files that are left have more than a whole file's bytes together
    bound = 1 + 2 * F.sum("bytes") / versions.FILE_BYTES
    return by_file.groupBy(*dates).agg(
        F.sum("n").alias("row_count"), F.sum("ids").alias("total"), (F.count(F.lit(1)) <= bound).alias("few_files")
    )


_CHANGED_SQL = """a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
    b AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 997 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM a WHERE o_orderkey % 1009 <> 2 UNION ALL SELECT * FROM a WHERE o_orderkey % 1013 = 3)"""


def _changed_orders(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders, and orders with some prices changed, some rows left out and some repeated."""
    a = t.read("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    price = F.when(key % 997 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    b = a.where(key % 1009 != 2).withColumn("o_totalprice", price)
    return a, b.unionByName(a.where(key % 1013 == 3)).repartition(5)


@query(
    f"""WITH {_CHANGED_SQL} SELECT CASE WHEN d.side = 0 THEN 'left' ELSE 'right' END AS side, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    ('0x' || substr(md5('0:' || o_orderkey), 1, 8))::BIGINT % 64 AS bucket
    FROM (SELECT 0 AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
        UNION ALL SELECT 1, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) d"""
)
def table_difference(t: Tables) -> DataFrame:
    """Changed, lost and doubled orders, found by comparing fingerprints of buckets first."""
    a, b = _changed_orders(t)
    return contract.table_difference(a, b, ["o_orderkey"], buckets=64)


@query(
    f"""WITH {_CHANGED_SQL}, l AS (SELECT ('0x' || substr(md5('0:' || o_orderkey), 1, 8))::BIGINT % 512 AS bucket, * FROM a),
    r AS (SELECT ('0x' || substr(md5('0:' || o_orderkey), 1, 8))::BIGINT % 512 AS bucket, * FROM b),
    d AS (SELECT bucket FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION SELECT bucket FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l))
    SELECT bucket, (SELECT count(*) FROM l WHERE l.bucket = d.bucket) AS left_rows,
    (SELECT count(*) FROM r WHERE r.bucket = d.bucket) AS right_rows FROM d"""
)
def differing_buckets(t: Tables) -> DataFrame:
    a, b = _changed_orders(t)
    return contract.differing_buckets(a, b, ["o_orderkey"], buckets=512)
