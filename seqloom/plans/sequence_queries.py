"""User histories, splits and training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import sampling, sequences
from seqloom.plans.bindings import BIG_ORDER, FIT_POSITIONS, RATING_ORDER, Tables, samples_cte
from seqloom.plans.registry import as_text, query
from seqloom.session import scratch_path

_LISTS = """CAST(to_json(item_seq) AS VARCHAR) AS item_seq, CAST(to_json(time_seq) AS VARCHAR) AS time_seq,
    CAST(to_json(genre_seq) AS VARCHAR) AS genre_seq"""


def _as_rows(samples: DataFrame) -> DataFrame:
    return samples.withColumns(
        {"item_seq": as_text("item_seq"), "time_seq": as_text("time_seq"), "genre_seq": as_text("genre_seq")}
    )


@query(
    """SELECT user_id, (pos - 1) // 25 AS part, max(n) AS seq_len,
    CAST(to_json(list(item ORDER BY pos)) AS VARCHAR) AS item_seq, CAST(to_json(list(slot ORDER BY pos)) AS VARCHAR) AS time_seq,
    CAST(to_json(list(genres ORDER BY pos)) AS VARCHAR) AS genre_seq,
    CAST(to_json(list(rating_timestamp ORDER BY pos)) AS VARCHAR) AS timestamps,
    max(age_idx) AS age_idx, max(gender_idx) AS gender_idx, CAST(max(occupation) AS INTEGER) AS occupation
    FROM sequence_events JOIN profiles USING (user_id)
    WHERE n >= 5 AND age_idx IS NOT NULL AND gender_idx IS NOT NULL AND occupation IS NOT NULL GROUP BY user_id, part""",
    "sequence_events",
    "profiles",
)
def user_sequences(t: Tables) -> DataFrame:
    """Whole histories in parts of 25, each with its user's profile."""
    rows = sequences.user_sequences(
        t.sequence_events, RATING_ORDER, chunk=25, profiles=t.profiles, size_from=t.ratings
    )
    return _as_rows(rows).withColumn("timestamps", as_text("timestamps")).select("*", "user_profile.*").drop("user_profile")


@query(
    """SELECT user_id, CAST(to_json(list(item ORDER BY pos)) AS VARCHAR) AS item_seq
    FROM sequence_events WHERE n >= 5 GROUP BY user_id""",
    "sequence_events",
)
def user_sequences_joined(t: Tables) -> DataFrame:
    """The parts put together again give each user's whole history in order."""
    parts = sequences.user_sequences(t.sequence_events, RATING_ORDER, chunk=7, size_from=t.ratings)
    whole = parts.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("part", "item_seq"))).alias("p"))
    return whole.select("user_id", F.to_json(F.flatten("p.item_seq")).alias("item_seq"))


@query(
    """SELECT user_id, event_id, item, pos, CASE WHEN pos = n THEN 'test' WHEN pos = n - 1 THEN 'val' ELSE 'train' END AS split
    FROM sequence_events WHERE n >= 5""",
    "sequence_events",
)
def leave_one_out_split(t: Tables) -> DataFrame:
    rows = sequences.leave_one_out_split(t.sequence_events, RATING_ORDER, size_from=t.ratings)
    return rows.select("user_id", "event_id", "item", "pos", "split")


@query(
    f"SELECT user_id, split, from_end, {_LISTS}, target, target_time, last_timestamp, gender_idx, age_idx, CAST(occupation AS INTEGER) AS occupation FROM capped_samples",
    "capped_samples",
)
def training_samples(t: Tables) -> DataFrame:
    """Capped samples with profiles, what a classifier is fitted on: the flagship job."""
    return _as_rows(t.capped_samples).select("*", "user_profile.*").drop("user_profile")


_SAMPLE_COLUMNS = f"user_id, split, from_end, {_LISTS}, target, target_time, last_timestamp"


@query(f"SELECT {_SAMPLE_COLUMNS} FROM ({samples_cte('sequence_events')})", "sequence_events")
def training_samples_all(t: Tables) -> DataFrame:
    """Samples for every train position."""
    return _as_rows(sequences.training_samples(t.sequence_events, RATING_ORDER, size_from=t.ratings))


@query(f"SELECT {_SAMPLE_COLUMNS} FROM ({samples_cte('sequence_events_big', FIT_POSITIONS)})", "sequence_events_big")
def training_samples_big(t: Tables) -> DataFrame:
    """Capped samples over the order lines."""
    return _as_rows(
        sequences.training_samples(t.sequence_events_big, BIG_ORDER, max_train_per_user=FIT_POSITIONS)
    )


@query(
    """SELECT user_id, from_end,
    CAST(to_json(list_concat(list_transform(range(50 - len(item_seq)), lambda x: 0), item_seq)) AS VARCHAR) AS item_seq,
    CAST(to_json(list_concat(list_transform(range(50 - len(time_seq)), lambda x: 0), time_seq)) AS VARCHAR) AS time_seq
    FROM raw_samples""",
    "raw_samples",
)
def pad_sequences(t: Tables) -> DataFrame:
    padded = sequences.pad_samples(
        sequences.training_samples(t.sequence_events, RATING_ORDER, size_from=t.ratings)
    )
    return _as_rows(padded).select("user_id", "from_end", "item_seq", "time_seq")


@query(
    """SELECT user_id, from_end, CAST(to_json(
        list_concat(list_transform(range(50 - len(genre_seq)), lambda x: [0, 0, 0]), genre_seq)) AS VARCHAR) AS genre_seq FROM raw_samples""",
    "raw_samples",
)
def pad_genre_sequences(t: Tables) -> DataFrame:
    padded = sequences.pad_samples(
        sequences.training_samples(t.sequence_events, RATING_ORDER, size_from=t.ratings)
    )
    return _as_rows(padded).select("user_id", "from_end", "genre_seq")


@query(
    """SELECT event_id, CASE WHEN CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
    FROM events"""
)
def hash_split(t: Tables) -> DataFrame:
    return sampling.hash_split(t.events, ["event_id"]).select("event_id", "split")


@query(
    """SELECT movie_id FROM movies ORDER BY CAST('0x' || substr(md5('42:' || movie_id), 1, 8) AS BIGINT), movie_id LIMIT 200""",
    "movies",
)
def eligible_subset(t: Tables) -> DataFrame:
    return sampling.eligible_subset(t.movies, "movie_id")


@query("SELECT user_id, split, from_end, target FROM samples", "samples")
def training_export(t: Tables) -> DataFrame:
    """Samples written as shuffled batches and read back."""
    path = scratch_path(t.spark, "export")
    sampling.training_export(t.samples, path, key=["user_id", "from_end"], shards=8)
    return t.spark.read.parquet(path).select("user_id", "split", "from_end", "target")
